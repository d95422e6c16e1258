"""Secret scans in DataFrame functions only.

Base spans come from three patterns: assignments of a secret-like name,
access-key ids and long hexadecimal runs.  To these are added spans found by
entropy: over every candidate string (a run of key characters), per character
class, a window slides by one character; the count of the entering character
rises, that of the leaving one falls, and the sum of ``c log2 c`` is adjusted
by the two changes, so each step costs the class's alphabet, not the window.
Where the entropy reaches the class's threshold, the span from the first such
window to the end of the last one is reported, unless the allow list
suppresses the candidate or a base span covers it.

Positions are in code points, end exclusive.  They follow from the lengths of
the matches and of the texts between them, in one pass per pattern, and only
texts that contain a match are split at all.

Defined results: a NULL text counts as empty and has no spans (in ``redact``
it stays NULL); overlapping spans of different kinds are all reported, and
redacted as one; repeated rows are scanned each; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import let

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
#: Maximal runs, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = "[A-Za-z0-9+/_-]{24,}"
SPAN = "array<struct<start:bigint,order:int,end:bigint>>"


@dataclass(frozen=True)
class CharClass:
    """Candidates in which ``pattern`` is found are measured against ``bits``
    of entropy in a window of ``window`` characters."""

    name: str
    pattern: str
    bits: float
    window: int = 24


#: A part of a candidate lies between separators.  Parts of lower-case
#: hexadecimal digits alone are base spans already.
_PART = r"(?<![A-Za-z0-9])%s{24,}(?![A-Za-z0-9])"
CLASSES = (
    CharClass("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.2),
    CharClass("alnum", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$|^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.7),
    CharClass("hex part", _PART % "(?=[0-9A-Fa-f]*[A-F])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]", 3.2),
    CharClass(
        "alnum part",
        _PART % "(?=[a-z0-9]*[g-z])(?=[a-z]*[0-9])[a-z0-9]" + "|" + _PART % "(?=[A-Z0-9]*[G-Z])(?=[A-Z]*[0-9])[A-Z0-9]",
        3.7,
    ),
    CharClass("mixed", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 4.0),
    CharClass("separated", r"^(?=.*[0-9])(?=.*[A-Za-z]).+$", 4.0),
    CharClass("letters", r"^(?=.*[A-Z][a-z][A-Z])[A-Za-z+/_-]+$", 4.2),
)
#: For words that mark an example: not if a part without them may be a key.
_NO_OTHER = r"(?i)^(?!.*(?<![A-Za-z0-9])(?![A-Za-z0-9]*(?:%s))(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{24,}).*(?:%s)"
_MARKS, _RUNS = "example|sample|placeholder|dummy|xxxx", "0123456789|abcdefghij|1234567890"
#: Candidates that are not secrets: documentation examples, runs of one
#: alphabet in order, UUIDs, dated or versioned names of words.
ALLOW = (
    _NO_OTHER % (_MARKS, _MARKS),
    _NO_OTHER % (_RUNS, _RUNS),
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?!.*[A-Z][a-z][A-Z])[A-Za-z]+([_/-][A-Za-z]+)*([_/-][0-9]{1,8})*$",
)

_BLOCK = 256


def _sums_before(lengths: Column) -> Column:
    """For an array of longs, the sum of the elements before each: running
    sums within blocks of 256, then over the blocks."""
    zero = F.lit(0).cast("long")

    def running(xs):
        start = F.struct(zero.alias("sum"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(
            xs,
            start,
            lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["before"], F.array(s["sum"])).alias("before")),
        )

    def in_blocks(xs):
        n_blocks = F.ceil(F.size(xs) / F.lit(_BLOCK)).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), n_blocks - 1), lambda b: running(F.slice(xs, b * _BLOCK + 1, F.lit(_BLOCK)))
        )
        return let(
            blocks,
            lambda bs: let(
                running(F.transform(bs, lambda b: b["sum"]))["before"],
                lambda base: F.flatten(
                    F.transform(bs, lambda b, i: F.transform(b["before"], lambda x: x + F.get(base, i)))
                ),
            ),
        )

    return let(lengths, lambda xs: F.when(F.size(xs) > 0, in_blocks(xs)).otherwise(F.array().cast("array<bigint>")))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), code
    points, ``value`` being the group's text."""
    lengths = lambda xs: F.transform(xs, lambda x: F.length(x).cast("long"))

    def found(found_texts, rest):
        steps = F.zip_with(
            lengths(F.slice(rest, F.lit(1), F.size(found_texts))), lengths(found_texts), lambda a, b: a + b
        )
        values = found_texts if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return let(
            _sums_before(steps),
            lambda before: let(
                values,
                lambda vs: F.transform(
                    found_texts,
                    lambda m, i: let(
                        F.get(before, i) + F.length(F.get(rest, i)),
                        lambda at: F.struct(
                            at.cast("long").alias("start"),
                            (at + F.length(m)).cast("long").alias("end"),
                            F.get(vs, i).alias("value"),
                        ),
                    ),
                ),
            ),
        )

    texts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(
        F.regexp_like(text, F.lit(pattern)), let(texts, lambda a: let(F.split(text, pattern, -1), lambda b: found(a, b)))
    ).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("order"), x["end"].alias("end"))
    ).cast(SPAN)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then kind."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_VALUE)
    return F.array_sort(
        F.concat(_spans(assign, 0), _spans(matches(text, ACCESS), 1), _spans(matches(text, HEX), 2))
    )


def _clog(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _hot_range(value: Column, bits: Column, window: int) -> Column:
    """(first, last, window): where the first and last window of at least
    ``bits`` start in ``value``; -1 where there is none."""

    def finish(s):
        return F.struct(s["first"].alias("first"), s["last"].alias("last"), F.lit(window).alias("window"))

    def walk(chars, letters):
        codes = F.transform(chars, lambda c: F.array_position(letters, c).cast("int") - 1)
        start = F.struct(
            F.array_repeat(F.lit(0), F.size(letters)).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(-1).alias("first"),
            F.lit(-1).alias("last"),
            F.lit(0).alias("at"),
        )

        def step(codes):
            def one(s, code):
                gone = F.when(s["at"] >= window, F.get(codes, s["at"] - window)).otherwise(F.lit(-1))
                less = F.when(gone >= 0, F.get(s["counts"], gone)).otherwise(F.lit(0))
                # The leaving character first: it may be the entering one.
                more = F.get(s["counts"], code) - (gone == code).cast("int")
                total = s["sum"] - _clog(less) + _clog(less - 1) + _clog(more + 1) - _clog(more)
                entropy = F.log2(F.lit(float(window))) - total / F.lit(float(window))
                hot = (s["at"] >= window - 1) & (entropy >= bits - 1e-9)
                begin = s["at"] - (window - 1)
                return F.struct(
                    F.transform(
                        s["counts"], lambda c, j: c + (j == code).cast("int") - (j == gone).cast("int")
                    ).alias("counts"),
                    total.alias("sum"),
                    F.when(hot & (s["first"] < 0), begin).otherwise(s["first"]).alias("first"),
                    F.when(hot, begin).otherwise(s["last"]).alias("last"),
                    (s["at"] + 1).alias("at"),
                )

            return one

        return let(codes, lambda cs: F.aggregate(cs, start, step(cs), finish))

    chars = F.split(value, "", -1)
    # split("") leaves an empty string at the end.
    return let(
        F.filter(chars, lambda c: c != ""), lambda cs: let(F.array_distinct(cs), lambda letters: walk(cs, letters))
    )


def entropy_spans(
    text: Column, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW
) -> Column:
    """Spans of high-entropy windows in candidate strings, by start."""
    allowed = lambda v: F.regexp_like(v, F.lit("|".join(f"(?:{a})" for a in allow)))

    def walked(value, window):
        return lambda bits: F.when(bits.isNotNull(), _hot_range(value, bits, window))

    def measured(c):
        by_class = F.lit(None).cast("struct<first:int,last:int,window:int>")
        for w in sorted({k.window for k in classes}):
            bits = F.lit(None).cast("double")
            for k in reversed(classes):
                own = F.lit(k.bits if k.window == w else None).cast("double")
                bits = F.when(F.regexp_like(c["value"], F.lit(k.pattern)), own).otherwise(bits)
            by_class = F.coalesce(by_class, let(bits, walked(c["value"], w)))
        return let(
            by_class,
            lambda r: F.when(
                r["first"] >= 0,
                F.struct(
                    (c["start"] + r["first"]).alias("start"),
                    F.lit(3).alias("order"),
                    (c["start"] + r["last"] + r["window"]).alias("end"),
                ),
            ),
        )

    candidates = F.filter(matches(text, CANDIDATE), lambda c: ~allowed(c["value"]))
    return F.filter(F.transform(candidates, measured), lambda x: x.isNotNull()).cast(SPAN)


def scan(text: Column, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> Column:
    """Struct (base, spans): base spans, and all spans, by start then kind."""
    whole = F.coalesce(text, F.lit(""))
    covered = lambda base, x: F.exists(base, lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"]))
    return let(
        base_spans(whole),
        lambda base: F.struct(
            base.alias("base"),
            F.array_sort(
                F.concat(base, F.filter(entropy_spans(whole, classes, allow), lambda x: ~covered(base, x)))
            ).alias("spans"),
        ),
    )


def spelled(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["order"]), x["start"], x["end"])), ","
    )


def find_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, default all) with ``base``
    and ``spans`` (arrays of start, order, end; ``KINDS[order]`` is the kind)."""
    kept = list(docs.columns if keep is None else keep)
    return docs.select(F.struct(*kept).alias("row"), scan(F.col(text_col)).alias("found")).select("row", "found.*")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, masked."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(s, x):
        new = x["start"] >= s["at"]
        cut = F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(new, F.concat(s["out"], cut, F.lit(mask))).otherwise(s["out"]).alias("out"),
        )

    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets of their texts masked, columns as given;
    ``length_col``, if named, becomes the new length in characters."""
    found = find_secrets(docs, text_col)
    out = found.select("row", redacted(F.col("row")[text_col], F.col("spans"), mask).alias("text"))
    columns = [
        F.col("text").alias(c)
        if c == text_col
        else F.length("text").cast(docs.schema[c].dataType).alias(c)
        if c == length_col
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return out.select(*columns)
