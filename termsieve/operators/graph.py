"""A category graph: index, seed matching, breadth-first lists with exclusions, and list comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termsieve.functions.text import alternation
from termsieve.scratch import held

NAMES = "array<string>"


def category_index(info: DataFrame, linkage: DataFrame) -> DataFrame:
    """info (key, name, hidden, num_pages, num_subcats) with parents, parents_visible and subcats_visible.

    linkage is (key, parents: keys). Lists hold names in order; unknown and hidden parents are not in the visible
    ones. Keys that only the linkage has keep a row of nulls.
    """
    nothing = F.array().cast(NAMES)
    base = info.join(linkage.select("key", "parents"), "key", "full").withColumn("parents", F.coalesce("parents", nothing))
    shown = info.where(~F.col("hidden")).select(F.col("key").alias("_parent"), F.col("name").alias("_pname"))
    up = base.where(F.col("name").isNotNull()).select("key", "name", "hidden", F.explode("parents").alias("_parent")).join(shown, "_parent")
    parents = up.groupBy("key").agg(F.array_sort(F.collect_set("_pname")).alias("parents_visible"))
    down = up.where(~F.col("hidden")).groupBy(F.col("_parent").alias("key")).agg(F.array_sort(F.collect_set("name")).alias("subcats_visible"))
    out = base.join(parents, "key", "left").join(down, "key", "left")
    return out.withColumns({c: F.coalesce(c, nothing) for c in ("parents_visible", "subcats_visible")})


def unknown_parents(info: DataFrame, linkage: DataFrame) -> DataFrame:
    """Number of parent keys that the info table does not have."""
    keys = linkage.select(F.explode("parents").alias("key"))
    return keys.join(info.select("key"), "key", "left_anti").agg(F.count("*").alias("n_unknown"))


def parents_flag(cats: DataFrame) -> DataFrame:
    """(key, name, parent, parent_in_list) for each visible parent of the categories."""
    listed = cats.select(F.col("name").alias("_listed")).distinct()
    rows = cats.select("key", "name", F.explode_outer("parents_visible").alias("parent"))
    return rows.join(listed, F.col("parent") == F.col("_listed"), "left").select("key", "name", "parent", F.col("_listed").isNotNull().alias("parent_in_list"))


def match(index: DataFrame, names: Sequence[str] | None = None, regex: str | None = None, nonempty: bool = True) -> DataFrame:
    """Visible categories by exact name or by pattern, with seed (the name, else the matched text) and
    has_parent_in_list."""
    exact = F.when(F.col("name").isin(list(names)), F.col("name")) if names else F.lit(None).cast("string")
    part = F.nullif(F.regexp_extract("name", f"(?i)({regex})", 1), F.lit("")) if regex else F.lit(None).cast("string")
    found = index.where(~F.col("hidden")).withColumn("seed", F.coalesce(exact, part)).where(F.col("seed").isNotNull())
    if nonempty:
        found = found.where(F.col("num_pages") + F.col("num_subcats") > 0)
    flags = parents_flag(found).groupBy("key").agg(F.bool_or("parent_in_list").alias("has_parent_in_list"))
    return found.drop("hidden", "parents").join(flags, "key", "left")


def links(index: DataFrame) -> DataFrame:
    """(_from, _to) for every visible subcategory, written out: each level of a walk joins them."""
    return held(index.select(F.col("name").alias("_from"), F.explode("subcats_visible").alias("_to")))


def walk(index: DataFrame, seeds: DataFrame, ignore_names: Iterable[str] = (), ignore_regex: str | None = None, max_level: int | None = None,
         edges: DataFrame | None = None) -> DataFrame:
    """(name, seed, parent, level) of everything below the seeds (name, seed), level by level.

    Exclusions hold for seeds and for every level. A name keeps the row of its lowest level, there the one of the
    smallest seed and then parent. 0 and None are no limit. Each level is one equi-join with the edges and one
    anti-join with what was seen, written out by checkpoint(), so plans don't grow and cycles end. edges: the links of
    the index, if they are there already.
    """

    def cut(df: DataFrame, c: str = "name") -> DataFrame:
        if ignore_names:
            df = df.where(~F.col(c).isin(list(ignore_names)))
        return df.where(~F.col(c).rlike(f"(?i){ignore_regex}")) if ignore_regex else df

    def first(df: DataFrame) -> DataFrame:
        row = F.min(F.struct(F.coalesce("seed", F.lit("")).alias("_s"), F.coalesce("parent", F.lit("")).alias("_p"), "seed", "parent", "level"))
        return df.groupBy("name").agg(row.alias("_r")).select("name", "_r.seed", "_r.parent", "_r.level")

    edges = links(index) if edges is None else edges
    now = held(first(cut(seeds).select("name", "seed", F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("level"))))
    found, level = now, 0
    while not now.isEmpty():
        level += 1
        if max_level and level > max_level:
            break
        below = cut(now.join(edges, F.col("name") == F.col("_from")).select(F.col("_to").alias("name"), "seed", F.col("name").alias("parent"), F.lit(level).cast("long").alias("level")))
        now = held(first(below).join(found.select("name"), "name", "left_anti"))
        found = found.unionByName(now)
    return found


@dataclass(frozen=True)
class Topic:
    """Seeds and exclusions of one topic."""

    topic: str
    seed_categories: Sequence[str] = ()
    seed_re: Sequence[str] = ()
    ignore_categories: Sequence[str] = ()
    ignore_re: Sequence[str] = ()
    max_level: int | None = None


@dataclass(frozen=True)
class Seeds:
    """Topics in order, and exclusions that hold for all of them."""

    topics: Sequence[Topic] = field(default_factory=tuple)

    @classmethod
    def from_yaml(cls, text: str) -> Seeds:
        import yaml

        rows = yaml.safe_load(text)["blocklist"]
        pick = lambda r, k: tuple(r.get(k) or ())
        return cls(tuple(Topic(r["topic"], pick(r, "seed_categories"), pick(r, "seed_re"), pick(r, "ignore_categories"), pick(r, "ignore_re"), r.get("max_level")) for r in rows))


def topic_list(index: DataFrame, t: Topic, ignore_names: Iterable[str] = (), ignore_re: Iterable[str] = (), edges: DataFrame | None = None) -> DataFrame:
    """The walk of one topic's matches, with its name."""
    seeds = match(index, t.seed_categories, alternation(t.seed_re)[4:] if t.seed_re else None)
    names, res = {*t.ignore_categories, *ignore_names}, [*t.ignore_re, *ignore_re]
    return walk(index, seeds.select("name", "seed"), sorted(names), "|".join(res) or None, t.max_level, edges).withColumn("topic", F.lit(t.topic))


def full_list(index: DataFrame, seeds: Seeds, ignore_names: Iterable[str] = (), ignore_re: Iterable[str] = ()) -> DataFrame:
    """All topics' lists; a name under several topics stays under the first one."""
    out, edges = None, links(index)
    for k, t in enumerate(seeds.topics):
        one = topic_list(index, t, ignore_names, ignore_re, edges).withColumn("_k", F.lit(k))
        out = one if out is None else out.unionByName(one)
    best = out.groupBy("name").agg(F.min_by(F.struct("seed", "parent", "level", "topic"), "_k").alias("_r"))
    return best.select("name", "_r.*")


def compare(previous: DataFrame, new: DataFrame, differing_only: bool = True, topic: str | None = None) -> DataFrame:
    """Two lists side by side by name and topic, with diff: added, removed, changed, moved or ''.

    What one side lacks reads '--'. moved (the name has rows under several topics) overrides the others and is
    decided before the restriction to one topic.
    """
    cols = ("seed", "parent", "level")

    def side(df: DataFrame, suffix: str) -> DataFrame:
        text = {"seed": F.col("seed"), "parent": F.coalesce("parent", F.lit("")), "level": F.coalesce("level", F.lit(-1)).cast("string")}
        return df.select("name", "topic", *[text[c].alias(f"{c}_{suffix}") for c in cols], F.lit(True).alias(f"_{suffix}"))

    both = side(previous, "previous").join(side(new, "new"), ["name", "topic"], "full")
    for s in ("previous", "new"):
        both = both.withColumns({f"{c}_{s}": F.when(F.col(f"_{s}").isNull(), "--").otherwise(F.col(f"{c}_{s}")) for c in cols})
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"{c}_previous").eqNullSafe(F.col(f"{c}_new"))
    moved = F.count("*").over(Window.partitionBy("name")) > 1
    diff = F.when(moved, "moved").when(F.col("_previous").isNull(), "added").when(F.col("_new").isNull(), "removed").when(differs, "changed").otherwise("")
    out = both.withColumn("diff", diff)
    if differing_only:
        out = out.where(differs)
    if topic:
        out = out.where(F.col("topic") == topic)
    return out.drop("_previous", "_new")


def node_kinds(index: DataFrame) -> DataFrame:
    """Numbers of sources (no visible parent), sinks (no visible child) and isolated nodes among the visible."""
    source, sink = F.size("parents_visible") == 0, F.size("subcats_visible") == 0
    return index.where(~F.col("hidden")).agg(
        F.count_if(source).alias("n_sources"), F.count_if(sink).alias("n_sinks"), F.count_if(source & sink).alias("n_isolated"), F.count("*").alias("n_visible"))


def members(walked: DataFrame, membership: DataFrame) -> DataFrame:
    """(page, categories): for every page (page, category) the categories of the walk that hold it."""
    hit = membership.join(walked.select(F.col("name").alias("category")).distinct(), "category", "left_semi")
    return hit.groupBy("page").agg(F.array_sort(F.collect_set("category")).alias("categories"))
