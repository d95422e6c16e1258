"""Token-ID files in Simple-8b coding, written and read by Spark.

A 64-bit word has a selector in its top four bits and packs as many ids as the
selector says: 60 of one bit, ... 4 of 15 bits, 3 of 20 bits, ... one of 60.
Selector 1 stands for 120 zeros, selector 0 is an escape: the next word holds
one id of more than 60 bits as it is.  Packing is greedy; the widest selector
that fits is computed for every position at once, and only the chain from word
to word is walked.

A file is a Parquet table of chunks, each of whole documents in order: their
ids and lengths, the words as one little-endian binary, and the word at which
every block of 1,024 ids begins, so a block can be decoded alone and all words
of one selector are decoded together.  ``part`` and ``first`` (ids before the
chunk in its part) give every document its global position once the sums of
the parts are known.

Defined results: a NULL or empty text has the end id alone; NULL document ids
come last; repeated rows and ids are stored each; an empty table gives an
empty file table.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.bpe import Memo
from tallymart.llm.common import ship_package

#: (ids in a word, bits of each) of selectors 2 to 15: fixed by the format.
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ZEROS = 120
ESCAPE, ZERO_RUN, FIRST_PACKING = 0, 1, 2
BLOCK = 1 << 10
#: A chunk is closed at so many ids; a longer document is a chunk of its own.
CHUNK = 1 << 16
#: Bytes that a worker's memory of space-free strings may take.
TABLE_BYTES = 128 << 20
MARK = "\x01"
#: Marks that follow a word; the split keeps a run of them apart from letters
#: (its forms of an apostrophe and letters need letters behind the apostrophe).
MARKS = string.punctuation
#: Latin-1 letters, which the normaliser only lowers.
LETTERS = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$"
SPECIAL = b"<|"
#: Bytes of text that are encoded at once, but for the last document's.
_SLICE = 2 << 20


def _byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others for code points from
    256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


BYTE_SIGNS = _byte_signs()

_lookups: dict[str, "Lookup"] = {}


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) that hold ``ids`` (unsigned), and the first word of
    every block."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    place = np.arange(n, dtype=np.int32)
    room = np.minimum(BLOCK - (place & (BLOCK - 1)), n - place)
    count = np.ones(n, np.int32)
    selector = np.zeros(n, np.int8)  # ids that fit nothing escape
    least, most = int(ids.min()), int(ids.max())
    options = [(c, bits, FIRST_PACKING + i) for i, (c, bits) in enumerate(PACKINGS)][::-1] + [(ZEROS, 0, ZERO_RUN)]
    wide = np.zeros(n + 1, np.int32)
    for c, bits, code in options:
        if c > n or least >> bits:
            continue
        fits = room[: n - c + 1] >= c
        if most >> bits:
            np.cumsum(ids >= np.array(1 << bits, ids.dtype), out=wide[1:])
            fits &= wide[c:] == wide[: n - c + 1]
            if not fits.any():
                break  # the options that follow take more ids, of fewer bits
        np.copyto(count[: n - c + 1], c, where=fits)
        np.copyto(selector[: n - c + 1], code, where=fits)
    steps, at, starts = count.tolist(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = selector[starts]
    place = np.cumsum(1 + (chosen == ESCAPE)) - 1 - (chosen == ESCAPE)
    words = np.zeros(place[-1] + 1 + (chosen[-1] == ESCAPE), np.uint64)
    for i, (c, bits) in enumerate(PACKINGS):
        mine = chosen == FIRST_PACKING + i
        if mine.any():
            first, values = starts[mine], np.uint64((FIRST_PACKING + i) << 60)
            for j in range(c):
                values = values | ids[first + j].astype(np.uint64) << np.uint64(j * bits)
            words[place[mine]] = values
    words[place[chosen == ZERO_RUN]] = np.uint64(ZERO_RUN << 60)
    raw = chosen == ESCAPE
    words[place[raw] + 1] = ids[starts[raw]]
    blocks = place[np.searchsorted(starts, np.arange(0, n, BLOCK))]
    return words, blocks.astype(np.int32)


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids (uint64) that ``words`` hold; any run of whole blocks will do."""
    code = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    last = -1
    for p in np.flatnonzero(code == ESCAPE):  # an escaped id may look like an escape
        if p > last:
            last = p + 1
            raw[last] = True
    sizes = np.array([0, ZEROS, *(c for c, _ in PACKINGS)])[code]
    sizes[raw] = 1
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint64)
    for i, (c, bits) in enumerate(PACKINGS):
        mine = (code == FIRST_PACKING + i) & ~raw
        if mine.any():
            shifts = np.arange(c, dtype=np.uint64) * np.uint64(bits)
            values = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[begin[mine][:, None] + np.arange(c)] = values
    out[begin[raw]] = words[raw]
    return out


class Lookup:
    """A tokenizer with a memory, bounded in bytes, of the ids of space-free
    strings.

    For vocabularies whose split drops white space and that lower their text:
    no token spans a space, so a text's ids are those of its lowered
    space-free strings in a row.  Strings not in the table are encoded many at
    a time, between control characters that have an id of their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.table = Memo(self._learn, TABLE_BYTES)
        (self.mark,) = self._ids(MARK)

    @classmethod
    def load(cls, path: str) -> "Lookup":
        if path not in _lookups:
            _lookups[path] = cls(path)
        return _lookups[path]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _letters(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of runs of Latin-1 letters: the normaliser only lowers them and
        the split leaves them as they are, so the library's model can be asked
        directly, with each byte written as its sign."""
        tokenize = self.model.tokenize
        for w in words:
            text = w.decode().lower()
            if not text.isascii():  # an ASCII letter is its own sign
                text = text.encode("utf-8").decode("latin-1").translate(BYTE_SIGNS)
            yield array("I", [t.id for t in tokenize(text)]).tobytes()

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Packed ids of space-free strings."""
        words, rest = [], []
        for w in new:
            letters = w.isalpha() or (text := w.decode()).isalpha() and max(text) <= "\xff"
            (words if letters else rest).append(w)
        learnt = dict(zip(words, self._letters(words)))
        plain = [w for w in rest if MARK.encode() not in w and SPECIAL not in w]
        for w in set(rest).difference(plain):
            learnt[w] = array("I", self._ids(w.decode())).tobytes()
        for at in range(0, len(plain), 2000):
            part = plain[at : at + 2000]
            ids = np.array(self._ids(f" {MARK} ".join([w.decode() for w in part])), "<u4")
            cuts = np.flatnonzero(ids == self.mark) * 4
            data = ids.tobytes()
            for w, a, b in zip(part, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)]):
                learnt[w] = data[a:b]
        return [learnt[w] for w in new]

    def _known(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct space-free strings in a row, and how many each has."""
        whole = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)
        keys = pc.binary_join(whole, pa.scalar(" ", strings.type))[0].as_py().encode().split(b" ")
        found = list(map(self.table.having(set(keys)).__getitem__, keys))
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all ``texts`` in a row, and how many each has.

        Each distinct space-free string is looked up once, as its letters and
        the marks behind them."""
        if not len(texts):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        texts = texts.fill_null("")
        # A special token's string counts in its own case only.
        cased = pc.match_substring(texts, SPECIAL.decode())
        split = pc.ascii_split_whitespace(pc.if_else(cased, texts, pc.ascii_lower(texts)))
        words = split.flatten().dictionary_encode()
        pieces = _apart(words.dictionary).dictionary_encode()
        ids, sizes = _taken(*self._known(pieces.dictionary), pieces.indices.to_numpy())
        ids, sizes = _taken(ids, sizes[0::2] + sizes[1::2], words.indices.to_numpy())
        edges = split.offsets.to_numpy()
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[edges - edges[0]])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        ids, sizes = self.rows(pa.array(texts, pa.binary()).cast(pa.string()))
        ends = np.cumsum(sizes)
        return [ids[a:b].tobytes() for a, b in zip(ends - sizes, ends)]


def _apart(words: pa.Array) -> pa.Array:
    """Two strings of each word: Latin-1 letters and the marks that end it, or
    the word and nothing."""
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    edges = np.frombuffer(words.buffers()[1], kind)[words.offset : words.offset + len(words) + 1]
    stems = pc.ascii_rtrim(words, MARKS)
    letters = pc.match_substring_regex(stems, LETTERS).to_numpy(zero_copy_only=False)
    cuts = np.where(letters, edges[:-1] + pc.binary_length(stems).to_numpy(), edges[1:])
    both = np.append(np.stack([edges[:-1], cuts], 1).ravel(), edges[-1]).astype(kind)
    return pa.Array.from_buffers(words.type, len(both) - 1, [None, pa.py_buffer(both), words.buffers()[2]])


def _taken(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``ids``, whose runs have ``sizes``, in a row, and
    the size of each."""
    starts, size = np.cumsum(sizes) - sizes, sizes[which]
    ends = np.cumsum(size)
    return ids[np.repeat(starts[which] - ends + size, size) + np.arange(ends[-1])], size


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``_SLICE`` bytes of text, the last row's besides."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64))
    edges = np.flatnonzero(np.diff(ends // _SLICE)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def _encode(path: str, end_id: int, id_type: pa.DataType):
    def chunk(part: int, number: int, first: int, docs: list, ids: list, lengths: list) -> pa.RecordBatch:
        words, blocks = pack(np.concatenate(ids))
        one = lambda x, kind: pa.array([x], kind)
        return pa.RecordBatch.from_arrays(
            [
                one(part, pa.int32()), one(number, pa.int64()), one(first, pa.int64()), one(sum(lengths), pa.int64()),
                one(docs, pa.list_(id_type)), one(lengths, pa.list_(pa.int64())),
                one(blocks, pa.list_(pa.int32())), one(words.astype("<u8").tobytes(), pa.binary()),
            ],
            names=["part", "chunk", "first", "n_ids", "docs", "lengths", "blocks", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        lookup = Lookup.load(path)
        part, number, first, held = TaskContext.get().partitionId(), 0, 0, 0
        docs, ids, lengths = [], [], []
        for batch in batches:
            for some in _slices(batch):
                names = some.column(0).to_pylist()
                data, sizes = lookup.rows(some.column(1))
                data, sizes = np.insert(data, np.cumsum(sizes), end_id), sizes + 1
                ends, a, at = np.cumsum(sizes), 0, 0
                while a < len(names):
                    b = min(int(np.searchsorted(ends, at + CHUNK - held)) + 1, len(names))
                    docs += names[a:b]
                    lengths += sizes[a:b].tolist()
                    ids.append(data[at : ends[b - 1]])
                    held, a, at = held + len(ids[-1]), b, int(ends[b - 1])
                    if held >= CHUNK:
                        yield chunk(part, number, first, docs, ids, lengths)
                        number, first, held, docs, ids, lengths = number + 1, first + held, 0, [], [], []
        if docs:
            yield chunk(part, number, first, docs, ids, lengths)

    return run


def write_tokens(
    docs: DataFrame, target: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode the texts of ``docs`` in ascending order of ``id_col`` and write
    them as token files under ``target``."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship_package(spark)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType
    order = F.col("id").asc_nulls_last()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartitionByRange(n, order).sortWithinPartitions(order)
    ordered.mapInArrow(
        _encode(tokenizer, end_id, to_arrow_type(kind)),
        f"part int, chunk long, first long, n_ids long, docs array<{kind.simpleString()}>, lengths array<long>,"
        " blocks array<int>, words binary",
    ).write.mode("overwrite").parquet(target)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            part, first = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            lengths = np.array(batch.column(3)[i].as_py(), np.int64)
            ids = unpack(np.frombuffer(batch.column(4)[i].as_py(), "<u8")).astype("<u4")
            ends = np.cumsum(lengths)
            data, edges = pa.py_buffer(ids.tobytes()), np.concatenate([[0], ends]) * 4
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lengths), [None, pa.py_buffer(edges.astype(np.int64).tobytes()), data]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2)[i].values,
                    pa.array(np.full(len(lengths), part, np.int32)),
                    pa.array(first + ends - lengths),
                    pa.array(lengths),
                    packed,
                ],
                names=["id", "part", "place", "n_tokens", "ids"],
            )


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """Documents of the token files under ``target``: id, start (ids of all
    documents before), n_tokens, ids (packed little-endian unsigned 32-bit)."""
    ship_package(spark)
    files = spark.read.parquet(target)
    kind = files.schema["docs"].dataType.elementType.simpleString()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: as many as the writer had partitions.
    bases = (
        files.groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .select(F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    docs = files.select("part", "first", "docs", "lengths", "words").mapInArrow(
        _decode, f"id {kind}, part int, place long, n_tokens long, ids binary"
    )
    return docs.join(F.broadcast(bases), F.col("part") == F.col("of_part")).select(
        "id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids"
    )


def ids_of(packed: Column) -> Column:
    """Packed ids as an array of longs."""

    @F.arrow_udf("array<long>")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(v.as_py(), "<u4").astype(np.int64) for v in values], pa.list_(pa.int64()))

    return run(packed)
