"""Joins between sources: exact, one to many, through aliases, and by similar names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlab.functions.clean import fold_name
from statlab.session import side_by_side, stage



def inner_match(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both sides with the same key; rows without a partner are dropped."""
    return left.join(right, list(key), "inner")


def one_to_many(left: DataFrame, right: DataFrame, key: str, latest_by: Sequence[str] = ()) -> DataFrame:
    """Each left row with all its right rows.

    ``latest_by`` adds ``is_latest`` from an aggregate per key, so a key with very many rows is
    never sorted in one task.
    """
    joined = left.join(right, key, "inner")
    if not latest_by:
        return joined
    newest = right.groupBy(key).agg(F.max(F.struct(*latest_by)).alias("newest"))
    return joined.join(newest, key).withColumn("is_latest", F.struct(*latest_by) == F.col("newest")).drop("newest")


def alias_table(spark: SparkSession, aliases: dict[str, str]) -> DataFrame:
    """``alias, full_name`` from a written list."""
    return spark.createDataFrame(list(aliases.items()), "alias string, full_name string")


def resolve_alias(df: DataFrame, name: str, aliases: dict[str, str] | DataFrame, resolved: str) -> DataFrame:
    """``resolved`` holds the full name for a known alias and the name itself otherwise.

    A long list of aliases is passed as a table ``alias, full_name`` with one row per alias; the planner chooses the join.
    """
    known = aliases if isinstance(aliases, DataFrame) else alias_table(df.sparkSession, aliases)
    known = known.select(F.col("alias").alias("_alias"), F.col("full_name").alias("_full_name"))
    joined = df.join(known, F.col(name) == F.col("_alias"), "left")
    return joined.withColumn(resolved, F.coalesce("_full_name", name)).drop("_alias", "_full_name")


def contradicting(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two names disagree; a missing name does not count as a disagreement."""
    return df.where(F.col(left) != F.col(right))


def _without_one(text: Column) -> Column:
    shorter = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.concat(text.substr(F.lit(1), i - 1), text.substr(i + 1, F.length(text))),
    )
    return F.when(F.length(text) > 0, shorter).otherwise(F.array().cast("array<string>"))


def _with_keys(names: DataFrame, max_distance: int) -> DataFrame:
    """One row per name and per text that is left after up to ``max_distance`` deletions."""
    rings = names.withColumn("ring0", F.array("folded"))
    for d in range(1, max_distance + 1):
        shorter = F.flatten(F.transform(F.col(f"ring{d - 1}"), _without_one))
        rings = rings.withColumn(f"ring{d}", F.array_distinct(shorter))
    variants = F.array_distinct(F.concat(*[F.col(f"ring{d}") for d in range(max_distance + 1)]))
    return rings.select("block", "folded", F.explode(variants).alias("variant")).select(
        "folded", "block", F.xxhash64("block", "variant").alias("key")
    )


def similar_names(
    left: DataFrame, right: DataFrame, max_distance: int, best_only: bool = True
) -> DataFrame:
    """``block, folded, match, distance`` for names at most ``max_distance`` edits apart.

    Two texts that close always share a text reached by that many deletions from each, so the
    pairs come from an equi-join on those texts. Names of a block are never paired with each other
    wholesale, and no partner is left out. The keys are written first, so the planner knows how
    many there are; a pair that meets under several keys is measured once.
    """
    keys = stage(_with_keys(left, max_distance), "keys-left")
    other = stage(_with_keys(right, max_distance).withColumnsRenamed({"folded": "match", "block": "right_block"}), "keys-right")
    pairs = keys.join(other, "key").where(F.col("block") == F.col("right_block")).select("block", "folded", "match").distinct()
    near = pairs.withColumn("distance", F.levenshtein("folded", "match", max_distance)).where("distance >= 0")
    if best_only:
        best = near.groupBy("block", "folded").agg(F.min(F.struct("distance", "match")).alias("best"))
        return best.select("block", "folded", "best.match", "best.distance")
    return near


def _closest_names(names: DataFrame, known: DataFrame, max_distance: int) -> DataFrame:
    """The closest name of each: within one edit first, and only what is left over within two, three and so on."""
    found = None
    for limit in range(1, max_distance + 1):
        step = stage(similar_names(names, known, limit), f"within-{limit}")
        found = step if found is None else found.unionByName(step)
        if limit < max_distance:
            names = stage(names.join(step, ["block", "folded"], "left_anti"), "names-left-over")
            if not names.head(1):
                break
    return found


def names_sharing_words(names: DataFrame, known: DataFrame) -> DataFrame:
    """``block, folded, match, distance`` where all words of the shorter name stand in the longer.

    A pair meets at the rarest word of the name whose words are all shared, so frequent words make no pairs; a name
    with a word that the other side lacks has no match and is left out before.
    The match with the fewest further words wins, the first by name on a tie; these words are the distance.
    """
    def words(df: DataFrame, name: str, side: str) -> DataFrame:
        split = F.array_distinct(F.filter(F.split(name, " "), lambda w: w != ""))
        return df.select(F.col("block").alias(f"{side}_block"), F.col(name).alias(side), split.alias(f"{side}_words"))

    def meeting(small: DataFrame, s: str, large: DataFrame, l: str) -> DataFrame:
        placed = large.select(F.col(f"{l}_block").alias("_block"), F.explode(f"{l}_words").alias("_word"), l, f"{l}_words")
        counts = stage(placed.groupBy("_block", "_word").agg(F.count("*").alias("_n")), "words")
        asked = small.select("*", F.explode(f"{s}_words").alias("_word"))
        rarest = asked.withColumn("_block", F.col(f"{s}_block")).join(counts, ["_block", "_word"])
        rarest = rarest.groupBy(f"{s}_block", s, f"{s}_words").agg(F.min(F.struct("_n", "_word")).alias("_rarest"), F.count("*").alias("_known"))
        rarest = rarest.where(F.col("_known") == F.size(f"{s}_words"))
        rarest = rarest.select(s, f"{s}_words", F.col(f"{s}_block").alias("_block"), F.col("_rarest._word").alias("_word"))
        met = stage(rarest, "rarest").join(stage(placed, "placed"), ["_block", "_word"])
        return met.where(F.size(F.array_except(f"{s}_words", f"{l}_words")) == 0).select(
            F.col("_block").alias("block"), F.col("a").alias("folded"), F.col("b").alias("match"),
            (F.size(f"{l}_words") - F.size(f"{s}_words")).alias("distance"))

    left, right = words(names, "folded", "a"), words(known, "folded", "b")
    both = meeting(left, "a", right, "b").unionByName(meeting(right, "b", left, "a"))
    best = both.groupBy("block", "folded").agg(F.min(F.struct("distance", "match")).alias("best"))
    return best.select("block", "folded", "best.match", "best.distance")


def approx_name_join(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    right_id: str,
    block: tuple[str, str] | None,
    max_distance: int = 2,
    how: str = "inner",
    shared_words: bool = False,
) -> DataFrame:
    """Each left row with the right row of the closest name: ``match_name, match_id, distance``.

    ``block`` names a column on each side that has to agree, such as the team; with None a name
    may be matched across teams. ``shared_words`` also matches what is then left over, by names that
    hold all words of the other (``names_sharing_words``). Equal distances go to the first name, and among right rows of the
    same name to the first id. Only distinct names are compared, however many rows carry one; they
    are written once for both sides, and equal ones are taken first by a plain join.
    """
    def compared(name: str, side: int) -> list[Column]:
        place = F.col(block[side]).cast("string") if block else F.lit("")
        return [place.alias("block"), fold_name(F.col(name)).alias("folded")]

    usable = "folded is not null and block is not null"
    hit = F.struct(F.col(right_id).alias("match_id"), F.col(right_name).alias("match_name")).alias("hit")
    targets = (
        right.select(*compared(right_name, 1), hit).where(usable)
        .groupBy("block", "folded").agg(F.min("hit").alias("hit"))
        .select("block", F.col("folded").alias("match"), "hit.match_name", "hit.match_id")
    )
    names = left.select(*compared(left_name, 0)).where(usable).distinct()
    targets, names = side_by_side(
        left.sparkSession, [partial(stage, targets, "names-right"), partial(stage, names, "names-left")], 2
    )
    known = targets.select("block", F.col("match").alias("folded"))
    equal = names.join(known, ["block", "folded"], "left_semi").select(
        "block", "folded", F.col("folded").alias("match"), F.lit(0).alias("distance")
    )
    best = equal
    if max_distance > 0:
        rest = names.join(known, ["block", "folded"], "left_anti")
        best = equal.unionByName(_closest_names(stage(rest, "names-rest"), known, max_distance))
    if shared_words:
        best = stage(best, "names-best")
        over = names.join(best, ["block", "folded"], "left_anti")
        best = best.unionByName(names_sharing_words(stage(over, "names-over"), known))
    found = stage(
        best.join(targets, ["block", "match"]).select("block", "folded", "match_name", "match_id", "distance"),
        "names-found",
    )
    place, folded = compared(left_name, 0)
    return (
        left.withColumns({"_block": place, "_folded": folded})
        .join(found, (F.col("_block") == found["block"]) & (F.col("_folded") == found["folded"]), how)
        .select(*[left[c] for c in left.columns], "match_name", "match_id", "distance")
    )
