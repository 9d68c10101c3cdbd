"""Layouts that later reads profit from: bucketed tables (J2, J4, M1) and
clustering on several columns (O1).

A bucketed table is one that Spark's catalog knows as ``CLUSTERED BY``: two
tables with the same number of buckets on their join columns are joined, and a
table is grouped by them, without a shuffle.  Files and statement lie under the
table's root, so a session that does not know the table yet reads the
definition there.

Clustering sorts by a space-filling curve: the bits of the columns' ranks,
interleaved.  Each file then covers a small range of *every* column, and a
filter on any of them skips most files by their footers' minima and maxima.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import TableStore

BITS = 8                        # ranks per column: 256


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], num_buckets: int) -> DataFrame:
    """Write ``df`` as a table in ``num_buckets`` buckets of ``keys``, sorted by
    them.  One shuffle by the keys puts each bucket into one task and file."""
    store = TableStore(df.sparkSession, name)
    folder = f"{store.root}/bucketed"
    df.repartition(num_buckets, *keys).write.mode("overwrite").bucketBy(num_buckets, *keys).sortBy(*keys) \
        .option("path", folder).saveAsTable(name)
    store.update(lambda s: s | {"bucketed": {"path": folder, "keys": list(keys), "buckets": num_buckets, "ddl": ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)}})
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A bucketed table, in any session."""
    if not spark.catalog.tableExists(name):
        known = TableStore(spark, name).state().get("bucketed")
        if known is None:
            raise FileNotFoundError(f"table {name!r} is not stored in buckets")
        keys = ", ".join(f"`{k}`" for k in known["keys"])
        spark.sql(f"CREATE TABLE `{name}` ({known['ddl']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {known['buckets']} BUCKETS LOCATION '{known['path']}'")
    return spark.table(name)


def curve_key(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Interleaved bits of integer ranks below ``2 ** bits``, most significant
    first.  At most 63 bits in all."""
    if bits * len(ranks) > 63:
        raise ValueError("curve_key: more than 63 bits")
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + k))
    return key


def _number_below(bounds: Column, value: Column) -> Column:
    return F.size(F.filter(bounds, lambda b: b < value))


def cluster_by(df: DataFrame, columns: Sequence[str], num_files: int, bits: int = BITS, accuracy: int = 10_000) -> DataFrame:
    """Rows in ``num_files`` range partitions of the curve through the ranks of
    the (numeric or date) columns, sorted inside.  A rank is the number of
    approximate quantiles below the value (a frequent value takes several, so
    every bit splits the rows); nulls have rank 0.  The quantiles, ``2 ** bits -
    1`` numbers a column, come from one pass; rows of equal ranks are spread by
    a hash, so a frequent value does not fill one file.  A second pass takes the
    files' bounds on the curve, approximate quantiles too: a bound drawn from a
    sample can miss by half a file, and a file then reaches into its neighbour's
    range."""
    parts = [k / 2 ** bits for k in range(1, 2 ** bits)]
    number = {c: F.unix_date(c) if df.schema[c].dataType.typeName() == "date" else F.col(c).cast("double") for c in columns}
    cuts = df.agg(*[F.percentile_approx(number[c], parts, accuracy).alias(c) for c in columns]).first()
    ranks = []
    for c in columns:
        bounds = F.lit(list(cuts[c] or [])).cast("array<double>")
        ranks.append(F.when(F.col(c).isNull(), 0).otherwise(_number_below(bounds, number[c])).cast("int"))
    order = [F.col("_curve"), F.col("_spread")]
    rows = df.withColumns({"_curve": curve_key(ranks, bits), "_spread": F.xxhash64(*df.columns)})
    # a double of 53 bits: the curve's first, at most 40, then the hash's
    place = F.shiftright("_curve", max(0, bits * len(columns) - 40)) + (F.shiftright("_spread", 32) + 2 ** 31) / F.lit(2.0 ** 32)
    at = [k / num_files for k in range(1, num_files)]
    ends = rows.agg(F.percentile_approx(place, at, max(accuracy, 100 * num_files)).alias("ends")).first().ends if at else None
    file = _number_below(F.lit(list(ends or [])).cast("array<double>"), place)
    return rows.repartitionById(num_files, file).sortWithinPartitions(*order).drop("_curve", "_spread")
