"""Duplicates hidden by formatting: canonical form, 128-bit hash, counts with map-side combining.

A third hash checks for collisions: records with equal 128 bits but another check are told apart, not merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that print nothing: format characters, among them soft hyphen, zero-width space and byte order mark.
_INVISIBLE = r"[\p{Cf}\p{Cc}&&[^\s]]"
_ALNUM_RUN = r"[\p{L}\p{M}\p{N}]+"


def canonical_name(c: Column) -> Column:
    """Letters, marks and digits of a name, lower case; null equals blank."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{M}\p{N}]", ""))


def canonical_parts(c: Column) -> Column:
    """Runs of letters and digits, lower case and sorted, joined by a space: numbers stay separate numbers."""
    seen = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), _INVISIBLE, ""))
    return F.array_join(F.sort_array(F.regexp_extract_all(seen, F.lit(f"({_ALNUM_RUN})"), F.lit(1))), " ")


def unordered(*names: Column) -> list[Column]:
    """Values in an order that does not depend on which field they stand in."""
    a = F.sort_array(F.array(*names))
    return [a[i] for i in range(len(names))]


def with_format_hash(df: DataFrame, exact: list[Column], canonical: list[Column], seed: str = "") -> DataFrame:
    """Adds h1, h2 (a 128-bit hash of all parts) and h3, an independent hash that reveals collisions.

    Null and empty ``exact`` values differ; ``canonical`` values are never null.
    """
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in [*exact, *canonical]]
    return df.withColumns({f"h{i}": F.xxhash64(F.lit(f"{seed}{i}"), *parts) for i in (1, 2, 3)})


def format_groups(hashed: DataFrame, row_id: str) -> DataFrame:
    """One row per distinct record: (h1, h2, h3, keep, last, n_rows); h3 keeps records apart whose 128 bits collide.

    All aggregates are partial on the map side, so a record written a billion times is one row per task.
    """
    return hashed.groupBy("h1", "h2", "h3").agg(F.min(row_id).alias("keep"), F.max(row_id).alias("last"), F.count("*").alias("n_rows"))


def format_copies(df: DataFrame, row_id: str, exact: list[Column], canonical: list[Column], seed: str = "") -> DataFrame:
    """(keep, copy): each record that repeats another but for formatting, with the smallest id of its set.

    Rows delivered twice (same id) count once; rows with a null id are left out; an empty table gives
    an empty result. A set of any size stays spread: only its smallest id is aggregated, and the
    join back is one small row against the set's rows, which adaptive execution splits.
    """
    hashed = with_format_hash(df.filter(F.col(row_id).isNotNull()), exact, canonical, seed).select("h1", "h2", "h3", F.col(row_id).alias("_id"))
    groups = format_groups(hashed, "_id").filter("keep <> last").select("h1", "h2", "h3", "keep")
    return hashed.withColumnRenamed("_id", "copy").join(groups, ["h1", "h2", "h3"]).filter("copy <> keep").select("keep", "copy").distinct()


def format_collapsed(df: DataFrame, row_id: str, exact: list[Column], canonical: list[Column], seed: str = "") -> DataFrame:
    """One row per distinct record: ``keep`` (smallest id) and ``n_copies``, its number of distinct ids."""
    once = df.filter(F.col(row_id).isNotNull()).dropDuplicates([row_id])
    hashed = with_format_hash(once, exact, canonical, seed).select("h1", "h2", "h3", F.col(row_id).alias("_id"))
    return format_groups(hashed, "_id").select("keep", F.col("n_rows").alias("n_copies"))
