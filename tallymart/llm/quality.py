"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

A rule rejects a document whose feature exceeds a cutoff.  The rules are made
stricter together, in steps: each adds the next cutoff of one rule, in turn,
mildest first.  What a step rejects, a later one rejects too, so the steps are
tested in that order on labelled holdout documents, up to the first that is
not certified (fixed-sequence testing: no correction within a stratum).  With
``n`` good documents in the stratum, of which ``k`` are rejected by any rule at
a step, the hypothesis "the rules falsely reject more than ``risk`` of the good
documents" has the exact binomial p-value ``P(Bin(n, risk) <= k)``.

Strata with too few good documents for any certificate are judged together,
as one more stratum, with the strata that have no labels at all; which those
are follows from the numbers of labels, not from what is tested.  Over the
strata the level is divided (Bonferroni).  With probability ``1 - delta`` the
rules falsely reject at most ``risk`` of the good documents in every stratum
(the pooled ones: in their union).

Features are fixed functions of the text, so all labelled documents are
holdouts.  Base features and the base verdict are those of ``features``.

Defined results: a NULL, empty or blank text has no words and fails the base
rules; a NULL stratum is a stratum; a document with several labels counts as
good only if all of them say so; labels that are NULL or of no document, and
documents without labels, take no part in the choice; repeated rows each get
their verdict and count as often as they occur; where not even the pooled
strata can be certified, the base rules decide alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import BREAKS, let, words
from tallymart.session import materialize

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Cutoffs:
    """A rule: reject where ``feature`` (a SQL expression over the feature
    columns) exceeds a cutoff; ``grid`` lists the candidates, mildest first."""

    name: str
    feature: str
    grid: tuple[float, ...]


RULES = (
    Cutoffs("symbols", "n_symbols / greatest(word_chars, 1L)", (0.32, 0.24, 0.16, 0.12, 0.08, 0.06, 0.04, 0.02)),
    Cutoffs("capitals", "n_capitals / greatest(word_chars, 1L)", (0.8, 0.7, 0.6, 0.5, 0.45, 0.4)),
)
#: Share of good documents that the rules together may reject, and the
#: probability that the guarantee fails anywhere.
RISK, DELTA = 0.02, 0.05

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _n_matches(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern, -1)) - 1).cast("long")


def _window(ws: Column, i: Column) -> Column:
    return F.slice(ws, i + F.lit(1), F.lit(WINDOW))


def n_repeat_words(ws: Column) -> Column:
    """Words that lie in an 8-word window found at two or more places.

    One 64-bit hash per window tells whether any is repeated; only then are
    the windows sorted by two independent hashes (128 bits) with their place,
    repeated neighbours kept, and the words covered counted.
    """
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - WINDOW)

    def covered(w):
        keyed = F.array_sort(
            F.transform(
                starts(w),
                lambda i: F.struct(
                    F.xxhash64(_window(w, i)).alias("a"), F.xxhash64(_window(w, i), F.lit(1)).alias("b"), i.alias("i")
                ),
            )
        )
        same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"])
        found = let(
            keyed,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        F.coalesce(same(x, F.get(s, j - 1)), F.lit(False))
                        | F.coalesce(same(x, F.get(s, j + 1)), F.lit(False)),
                        x["i"],
                    ),
                ),
                lambda p: p.isNotNull(),
            ),
        )
        gaps = lambda p: F.transform(
            p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))).cast("long")
        )
        return F.aggregate(let(F.array_sort(found), gaps), F.lit(0).cast("long"), lambda a, x: a + x)

    hashes = lambda w: F.transform(starts(w), lambda i: F.xxhash64(_window(w, i)))
    any_twice = lambda w: let(hashes(w), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return let(
        ws,
        lambda w: F.when(F.size(w) <= WINDOW, F.lit(0).cast("long"))
        .when(any_twice(w), covered(w))
        .otherwise(F.lit(0).cast("long")),
    )


def features(text: Column) -> Column:
    """Struct of the base features, the capital letters and the base verdict."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BREAKS))) > 0)
    capitals = F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}+", ""))

    def of(ws):
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _n_matches(whole, SYMBOLS).alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            n_repeat_words(ws).alias("n_repeat_words"),
            capitals.cast("long").alias("n_capitals"),
        )

    return let(words(text), of)


def base_failed(f: str = "") -> Column:
    return F.expr(f"{f}n_words < 20 OR 100 * {f}n_repeat_words > 30 * {f}n_words")


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1, by Stirling's series at x + 8 and the recurrence."""
    y = x + F.lit(8.0)
    series = (
        (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    )
    product = x
    for i in range(1, 8):
        product = product * (x + float(i))
    return series - F.ln(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k): an exact sum.

    Terms are summed downwards from ``k``; below the mean each is the one
    above times ``j (1-p) / ((n-j+1) p)``, in a running product.  At or above
    the mean the value is about a half or more: 1 is returned, which only
    makes the test stricter.
    """
    k, n = k.cast("double"), n.cast("double")
    log_top = (
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1.0 - p))
    )
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(s, i):
        j = k - i + 1
        term = s["term"] * j * F.lit(1.0 - p) / ((n - j + 1) * F.lit(p))
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    down = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    total = F.aggregate(down, start, step, lambda s: s["sum"])
    return F.when(n == 0, F.lit(1.0)).when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * total))


def steps(rules: tuple[Cutoffs, ...] = RULES) -> list[tuple[float | None, ...]]:
    """The cutoffs of all rules (None: not in use yet) at every step."""
    now: list[float | None] = [None] * len(rules)
    out = []
    for j in range(max((len(r.grid) for r in rules), default=0)):
        for i, r in enumerate(rules):
            if j < len(r.grid):
                now[i] = float(r.grid[j])
                out.append(tuple(now))
    return out


def rejected(rules: tuple[Cutoffs, ...], cutoffs: tuple[float | None, ...]) -> str:
    """SQL predicate: a rule rejects at these cutoffs."""
    return " OR ".join(f"({r.feature}) > {c}" for r, c in zip(rules, cutoffs) if c is not None)


def certify(
    holdout: DataFrame, rules: tuple[Cutoffs, ...] = RULES, risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """One row per stratum and rule with its certified cutoff (NULL: none):
    ``(stratum, pooled, n_good, rule, cutoff)``; all ``pooled`` strata have
    those of their union.

    ``holdout`` has ``stratum``, ``good`` (boolean) and the feature columns,
    one row per labelled document that the base rules keep.  One aggregate
    counts the good documents that each step rejects; the rest works on that
    table of strata x steps.
    """
    ladder = steps(rules)
    over = [F.count_if(F.expr(rejected(rules, c))).alias(f"k{i}") for i, c in enumerate(ladder)]
    counts = holdout.where("good").groupBy("stratum").agg(F.count("*").alias("n_good"), *over)
    # The least n for which no false rejection at all is a certificate at the
    # level that is left if every stratum is tested, and the pooled one.
    strata = counts.agg(F.count("*").alias("strata"))
    least = F.ceil(F.ln(F.lit(delta) / (F.col("strata") + 1)) / F.ln(F.lit(1.0 - risk)))
    # One row on the right.
    sized = counts.join(F.broadcast(strata)).withColumn("pooled", F.col("n_good") < least)
    tested = sized.groupBy("pooled", F.when(~F.col("pooled"), F.col("stratum")).alias("of")).agg(
        F.sum("n_good").alias("n"),
        F.collect_list(F.struct("stratum", "n_good")).alias("members"),
        *[F.sum(f"k{i}").alias(f"k{i}") for i in range(len(ladder))],
    )
    tests = tested.agg(F.count("*").alias("tests"))
    climbed = F.aggregate(
        F.array(*[F.col(f"k{i}") for i in range(len(ladder))]),
        F.struct(F.lit(0).alias("done"), F.lit(True).alias("on")),
        lambda s, k: let(
            s["on"] & (binomial_tail(k, F.col("n"), risk) <= F.lit(delta) / F.col("tests")),
            lambda ok: F.struct((s["done"] + ok.cast("int")).alias("done"), ok.alias("on")),
        ),
        lambda s: s["done"],
    )
    # One row on the right.
    reached = tested.join(F.broadcast(tests)).select("pooled", climbed.alias("done"), F.inline("members"))
    cutoff = lambda i: F.get(F.array(F.lit(None).cast("double"), *[F.lit(c[i]).cast("double") for c in ladder]), F.col("done"))
    each = F.array(*[F.struct(F.lit(i).alias("rule"), cutoff(i).alias("cutoff")) for i in range(len(rules))])
    return reached.select("stratum", "pooled", "n_good", F.inline(each))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    rules: tuple[Cutoffs, ...] = RULES,
    risk: float = RISK,
    delta: float = DELTA,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, default all), the base
    features, ``base_failed``, ``failed_rules`` (names of the rules that
    reject) and ``kept``.  ``labels`` has doc_id and quality (1: good).

    Rows and features are written once: the calibration on the labelled rows
    and the verdicts on all read the same numbers.
    """
    kept = list(docs.columns if keep is None else keep)
    measured = materialize(
        docs.select(
            F.struct(*kept).alias("row"),
            F.col(id_col).alias("id"),
            F.col(stratum_col).alias("stratum"),
            features(F.col(text_col)).alias("f"),
        ),
        "quality-features",
    ).select("row", "id", "stratum", "f.*")
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.min("quality") == 1).alias("good"))
    )
    holdout = measured.drop("row").where(~base_failed()).join(marks, F.col("id") == F.col("label_id"))
    cutoffs = certify(holdout, rules, risk, delta)
    # Written first: its measured size lets Spark broadcast it, so no row of
    # the documents is shuffled by a stratum that holds most of them.
    chosen = [F.max(F.when(F.col("rule") == i, F.col("cutoff"))).alias(f"cutoff_{i}") for i in range(len(rules))]
    written = materialize(
        cutoffs.groupBy(F.col("stratum").alias("of_stratum"), "pooled").agg(*chosen), "quality-cutoffs"
    )
    own = written.where(~F.col("pooled")).withColumn("own", F.lit(True))
    # One row, NULL cutoffs where there is no pooled stratum: by an aggregate.
    rest = written.where("pooled").agg(*[F.max(f"cutoff_{i}").alias(f"rest_{i}") for i in range(len(rules))])
    of_own = [F.col(f"cutoff_{i}").alias(f"own_{i}") for i in range(len(rules))]
    judged = measured.join(
        own.select("of_stratum", "own", *of_own), F.col("stratum").eqNullSafe(F.col("of_stratum")), "left"
    ).join(F.broadcast(rest))
    for i in range(len(rules)):
        judged = judged.withColumn(f"cutoff_{i}", F.when(F.col("own"), F.col(f"own_{i}")).otherwise(F.col(f"rest_{i}")))
    failing = F.filter(
        F.array(
            *[
                F.when(F.coalesce(F.expr(f"({r.feature}) > cutoff_{i}"), F.lit(False)), F.lit(r.name))
                for i, r in enumerate(rules)
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return (
        judged.withColumn("failed_rules", failing)
        .select(
            "row",
            *BASE,
            base_failed().alias("base_failed"),
            "failed_rules",
            (~base_failed() & (F.size("failed_rules") == 0)).alias("kept"),
        )
    )


def filter_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, columns as given."""
    return judge(docs, labels, **options).where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
