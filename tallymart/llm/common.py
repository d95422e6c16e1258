"""Column expressions and helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tallymart

#: A word is a run of characters other than these (space, tab to carriage return).
BREAKS = " \t\n\x0b\x0c\r"
BREAK_RUN = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that
    Python tasks can import it wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = os.path.dirname(os.path.abspath(tallymart.__file__))
    target = os.path.join(os.path.abspath(tempfile.mkdtemp(prefix="tallymart-ship-")), "tallymart-package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tallymart", os.path.relpath(full, home)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: the element of a
    one-element array bound to a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text as an array (empty for NULL and blank texts)."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(body == "", F.array().cast(T.ArrayType(T.StringType()))).otherwise(F.split(body, BREAK_RUN))


def n_words(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.size(words(text)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (0 for a NULL id)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)), F.lit(0)).cast("int")


def fresh(df_columns: list[str], name: str) -> str:
    """``name``, with underscores appended until no column is called so."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name += "_"
    return name
