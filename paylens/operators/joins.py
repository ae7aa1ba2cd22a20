"""Join helpers: size-checked broadcast (J3) and folded-name link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.text import fold_text

# A side whose files hold more bytes than this is joined by shuffle.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def scan_bytes(df: DataFrame) -> int:
    """Bytes of all files that ``df`` reads (FileSystem metadata, no job)."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for uri in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri))
        total += int(p.getFileSystem(conf).getFileStatus(p).getLen())
    return total


def checked_broadcast(df: DataFrame, source: DataFrame | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` hinted for broadcast if the files it comes from are small.

    ``df`` must hold no more than a row for each row of ``source`` (default:
    ``df`` itself), a scan with all of its columns: a projection, a filter or
    a dedupe of it.  Then the files' bytes bound it, and planning runs no job.
    Beyond the bound the join is left to Spark, which shuffles, or broadcasts
    what turns out small at run time.  Sides without such a bound (aggregates)
    need no helper: adaptive execution measures them.
    """
    return F.broadcast(df) if scan_bytes(source if source is not None else df) <= max_bytes else df


# Folded keys are pure ASCII, so a key starting with this character can
# never equal one: it marks blank names spread out by a row hash.
_NO_MATCH = "\u00ff"


def folded_link(left: DataFrame, right: DataFrame, left_name: Column | str,
                right_name: Column | str, how: str = "left",
                key: str = "_name_key", one: bool = False) -> DataFrame:
    """Equi-join two frames on the accent-folded, lower-cased full name.

    Each left row meets every right row of its name, so a name that many on
    both sides share multiplies; ``one=True`` gives one row per left row
    instead, with the number of matches (``n_matches``) and the first match.

    Both keys become a plain hash-join key, so Spark shuffles (or
    broadcasts) on it like any equi-join.  Blank names never link.  On the
    left of a left join they get a unique, never-matching key made from a
    hash of the row, so they spread over all reducers instead of piling
    into the one that a shared blank key would hash to; the key is NULL
    again in the output.
    """
    lcol = F.col(left_name) if isinstance(left_name, str) else left_name
    rcol = F.col(right_name) if isinstance(right_name, str) else right_name
    lkey = F.nullif(fold_text(lcol, strip=True), F.lit(""))
    rk = (right.withColumn(key, F.nullif(fold_text(rcol, strip=True), F.lit("")))
          .filter(F.col(key).isNotNull()))
    if one:
        rk = rk.groupBy(key).agg(F.count(F.lit(1)).alias("n_matches"), F.min(F.struct(*right.columns)).alias("_first"))
        rk = rk.select(key, "n_matches", "_first.*")
    if how != "left":
        return left.withColumn(key, lkey).filter(F.col(key).isNotNull()).join(rk, on=key, how=how)
    spread = F.concat(F.lit(_NO_MATCH), F.xxhash64(*[F.col(c) for c in left.columns]).cast("string"))
    lk = left.withColumn(key, F.coalesce(lkey, spread))
    joined = lk.join(rk, on=key, how="left")
    return joined.withColumn(key, F.when(~F.col(key).startswith(_NO_MATCH), F.col(key)))


def hot_names(left: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys that hold over a ``parts``-th of all keyed rows, with ``_pieces``, the
    number of pieces that bring each under that share.  Fewer than ``parts``
    rows, whatever the input."""
    names = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = names.agg(F.sum("_n")).scalar()
    return (names.filter(F.col("_n") * F.lit(parts) > total)
            .select(key, F.ceil(F.col("_n") * F.lit(parts) / total).cast("int").alias("_pieces")))


def spread_folded_link(left: DataFrame, right: DataFrame, left_name: Column | str,
                       right_name: Column | str, how: str = "left",
                       key: str = "_name_key", parts: int = 200) -> DataFrame:
    """:func:`folded_link` where some names may hold a large share of the left
    rows (J7): the same rows, but a hot name is spread over tasks.

    Hot names are found by a partial count; there are fewer than ``parts``, so
    their list is broadcast.  Left rows of a hot name are cut into pieces by a
    row hash, the right rows of that name are repeated once per piece, and the
    join runs on (name, piece).  A hash, not a random number: a task that runs
    again after a lost executor deals its rows alike.  Left rows that are equal
    in all columns stay in one piece; a skewed piece is left to adaptive
    execution.  ``how`` is 'left' or 'inner' (a repeated right side has no other).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how!r}")
    lcol = F.col(left_name) if isinstance(left_name, str) else left_name
    rcol = F.col(right_name) if isinstance(right_name, str) else right_name
    row = F.xxhash64(*[F.col(c) for c in left.columns])
    keyed = left.withColumns({key: F.nullif(fold_text(lcol, strip=True), F.lit("")), "_row": row})
    hot = F.broadcast(hot_names(keyed, key, parts))
    rk = (right.withColumn(key, F.nullif(fold_text(rcol, strip=True), F.lit("")))
          .filter(F.col(key).isNotNull()).join(hot, key, "left")
          .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces"))
    blank = F.concat(F.lit(_NO_MATCH), F.col("_row").cast("string"))
    lk = keyed.filter(F.col(key).isNotNull()) if how == "inner" else keyed.withColumn(key, F.coalesce(key, blank))
    lk = (lk.join(hot, key, "left")
          .withColumn("_piece", F.coalesce(F.pmod("_row", "_pieces"), F.lit(0)).cast("int")).drop("_row", "_pieces"))
    joined = lk.join(rk, [key, "_piece"], how).drop("_piece")
    return joined.withColumn(key, F.when(~F.col(key).startswith(_NO_MATCH), F.col(key)))
