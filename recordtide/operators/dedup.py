"""Duplicate removal that rewrites references to the dropped members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.operators.skew import join_group_facts, left_lookup
from recordtide.session import cut_lineage, work_folder

# Fixed value: six characters of a content digest, appended to a name on collision.
HASH_SUFFIX = r"[0-9A-F][0-9a-f]{5}\z"


def canonical_rank(name: Column) -> Column:
    """Sort key that elects a canonical name: (length, has a digest suffix, name), suffix cut off."""
    intended = F.regexp_replace(name, HASH_SUFFIX, "")
    return F.struct(
        F.length(intended).alias("length"), name.rlike(HASH_SUFFIX).alias("suffixed"), intended.alias("intended"),
        name.alias("name"),
    )


def elect_canonical(members: DataFrame, content: str, name: str, family: str | None = None) -> DataFrame:
    """Per content with several members: ``(content, n, canonical)``.

    With ``family``, groups that mix families are left alone: equal by chance, not
    the same thing; a missing family is a family of its own. Missing content equals
    nothing. Count and minimum aggregate before the shuffle.
    """
    members = members.where(F.col(content).isNotNull())
    facts = [F.count("*").alias("n"), F.min(canonical_rank(F.col(name))).alias("best")]
    if family:
        facts += [F.min(family).alias("first_family"), F.max(family).alias("last_family"), F.count(family).alias("n_family")]
    groups = members.groupBy(content).agg(*facts).where(F.col("n") > 1)
    if family:
        one = (F.col("first_family") == F.col("last_family")) & (F.col("n_family") == F.col("n"))
        groups = groups.where((F.col("n_family") == 0) | one)
    return groups.select(content, "n", F.col("best.name").alias("canonical"))


def duplicate_members(members: DataFrame, content: str, name: str, family: str | None = None) -> DataFrame:
    """Every member of every duplicate group, one row each: ``(content, name, n, canonical)``."""
    groups = elect_canonical(members, content, name, family)
    return join_group_facts(members.select(content, name), groups, content, "n", F.col(name))


def remap_table(members: DataFrame, content: str, name: str, family: str | None = None) -> DataFrame:
    """``(old, new)`` for every dropped member."""
    rows = duplicate_members(members, content, name, family)
    return rows.where(F.col(name) != F.col("canonical")).select(
        F.col(name).alias("old"), F.col("canonical").alias("new")
    )


def rewrite_refs(rows: DataFrame, column: str, remap: DataFrame, spread: str | None = None) -> DataFrame:
    """Redirect references from dropped members to their canonical one."""
    by = F.col(spread) if spread else F.struct(*rows.columns)
    found = left_lookup(rows, column, remap.select("old", F.col("new").alias("_new")), "old", by)
    return found.withColumn(column, F.coalesce("_new", column)).drop("_new")


_WORDS = ("sum_0", "sum_1", "sum_2")


def _digest_words(slot: str = "slot", target: str = "target") -> list[Column]:
    digest = F.sha2(F.to_json(F.struct(F.col(slot).alias("slot"), F.col(target).alias("target"))), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16, 31)]


def _reference_print(refs: DataFrame) -> DataFrame:
    """Per owner a digest of its set of ``(slot, target)``: their number and three sums of hash words.

    Sums of digests do not depend on order and aggregate before the shuffle, so an
    owner with very many references is no burden on one task. They can be kept up to
    date by adding what comes and subtracting what goes.
    """
    sums = [F.sum(word).cast("decimal(38,0)").alias(name) for name, word in zip(_WORDS, _digest_words())]
    return refs.groupBy(F.col("owner").alias("id")).agg(F.count("*").alias("n_refs"), *sums)


def _node_key() -> Column:
    """Equal for nodes of equal content and equal references."""
    printed = F.concat_ws(":", "n_refs", *_WORDS)
    return F.sha2(F.concat(printed, F.lit("|"), "content"), 256)


class _Indexed:
    """Rows written in buckets of a key's hash, so that the rows of some keys are found by reading their buckets alone.

    Rows added later lie in small tables beside them.
    """

    def __init__(self, rows: DataFrame, key: str, bucket_rows: int):
        self.key, self.columns, self.added = key, rows.columns, []
        self.buckets = max(1, min(1024, rows.count() // bucket_rows))
        self.folder = work_folder(rows.sparkSession, "index")
        bucketed = rows.withColumn("_bucket", self._bucket(F.col(key)))
        # A bucket is cut up if a frequent key makes it large.
        bucketed.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(self.folder)
        self.written = rows.sparkSession.read.schema(bucketed.schema).parquet(self.folder)

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame) -> None:
        self.added.append(rows.select(*self.columns))

    def find(self, keys: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """The rows whose key is among written, distinct ``keys``, with the columns ``extra`` of these."""
        hit = [row["_bucket"] for row in keys.select(self._bucket(F.col(self.key)).alias("_bucket")).distinct().collect()]
        found = self.written.where(F.col("_bucket").isin(hit)).select(*self.columns)
        for rows in self.added:
            found = found.unionAll(rows)
        return found.join(keys.select(self.key, *extra), self.key)


def _resolved(steps: list[DataFrame]) -> DataFrame:
    """``(old, new)`` of all rounds, with every ``new`` a node that is left. Chains halve with each turn."""
    remap = cut_lineage(reduce(DataFrame.unionAll, steps))
    while len(steps) > 1:
        nexts = remap.select(F.col("old").alias("new"), F.lit(1).alias("_one")).join(remap.select("new").distinct(), "new", "left_semi")
        if nexts.isEmpty():
            break
        remap = cut_lineage(rewrite_refs(remap, "new", remap, "old"))
    return remap


def _regrouped(alive: DataFrame, edges: DataFrame, step: DataFrame, family: str | None) -> DataFrame:
    """The rounds after ``step``, each over all nodes that are left."""
    steps = []
    while not step.isEmpty():
        steps.append(step)
        dropped = step.select(F.col("old").alias("id"))
        alive = cut_lineage(alive.join(dropped, "id", "left_anti"))
        edges = edges.join(dropped.withColumnRenamed("id", "owner"), "owner", "left_anti")
        edges = cut_lineage(rewrite_refs(edges, "target", step, "owner").distinct())
        keyed = alive.join(_reference_print(edges), "id", "left").withColumn("key", _node_key())
        step = cut_lineage(remap_table(keyed, "key", "id", family))
    return _resolved(steps)


def dedup_fixpoint(
    nodes: DataFrame, refs: DataFrame, family: str | None = None, bucket_rows: int = 200_000, regroup_below: int = 1_000_000
) -> DataFrame:
    """Merge equal nodes until none are left: ``(old, new)`` over all rounds.

    ``nodes`` has ``id`` and ``content`` text, ``refs`` has ``owner``, ``slot`` and
    ``target``. Nodes are equal when content and references are; merging targets
    can make their owners equal, hence the rounds. Every round removes at least one
    node, so the loop ends by itself and needs no bound.

    Only the first round sees all nodes. A later one starts from the references to
    what the last round dropped: their owners' digests are brought up to date, and
    only the groups that such an owner leaves or joins are looked at. References and
    nodes lie in buckets of the column they are looked up by (``bucket_rows`` rows
    each), so that a round reads the buckets concerned. Tables of fewer rows than
    ``regroup_below`` are grouped anew in each round, which takes fewer jobs and gives
    the same result.
    """
    labels = ["id", "content"] + ([family] if family else [])
    edges = cut_lineage(refs.select("owner", "slot", "target").distinct())
    state = nodes.select(*labels).join(_reference_print(edges), "id", "left")
    state = cut_lineage(state.withColumn("key", _node_key()).withColumn("turn", F.lit(0)))
    step = cut_lineage(remap_table(state, "key", "id", family))
    if step.isEmpty():
        return step
    if state.count() + edges.count() < regroup_below:
        return _regrouped(state.select(*labels), edges, step, family)
    by_target = _Indexed(edges, "target", bucket_rows)
    by_id = by_key = None
    steps, dropped, changed = [], None, None
    while True:
        steps.append(step)
        gone = step.select(F.col("old").alias("id"))
        dropped = gone if dropped is None else dropped.unionAll(gone)
        redirected = step.select(F.col("old").alias("target"), "new")
        touched = by_target.find(redirected, ("new",)).join(dropped.select(F.col("id").alias("owner")), "owner", "left_anti")
        touched = cut_lineage(touched.select("owner", "slot", "target", "new").distinct())
        if touched.isEmpty():
            break
        # A redirected reference may meet one that is there already, and two of them may meet.
        coming = cut_lineage(touched.select("owner", "slot", F.col("new").alias("target")).distinct())
        there = by_target.find(cut_lineage(coming.select("target").distinct()))
        coming = cut_lineage(coming.join(there.select("owner", "slot", "target").distinct(), ["owner", "slot", "target"], "left_anti"))
        by_target.add(coming)
        moves = touched.select("owner", "slot", "target", F.lit(-1).alias("sign")).unionAll(coming.select("owner", "slot", "target", F.lit(1).alias("sign")))
        delta = [F.sum(word * F.col("sign")).cast("decimal(38,0)").alias(f"_{name}") for name, word in zip(_WORDS, _digest_words())]
        delta = cut_lineage(moves.groupBy(F.col("owner").alias("id")).agg(F.sum("sign").alias("_n_refs"), *delta))
        if by_id is None:
            by_id = _Indexed(state, "id", bucket_rows)
            by_key = _Indexed(state.select("key", "id", "turn", *labels[2:]), "key", bucket_rows)
        # An owner that is no node has nothing to be merged with. Of its states the last one counts.
        counts = ["n_refs", *_WORDS]
        facts = [name for name in by_id.columns if name not in ("id", "turn")]
        before = by_id.find(delta, tuple(f"_{name}" for name in counts))
        before = before.groupBy("id").agg(F.max_by(F.struct(*facts, *[f"_{name}" for name in counts]), "turn").alias("last")).select("id", "last.*")
        after = before.withColumnsRenamed({"key": "_key"}).withColumns({name: F.col(name) + F.col(f"_{name}") for name in counts})
        after = after.withColumns({name: F.col(name).cast(by_id.written.schema[name].dataType) for name in counts})
        after = cut_lineage(after.withColumns({"key": _node_key(), "turn": F.lit(len(steps))}))
        by_id.add(after)
        by_key.add(after)
        latest = after.select("id", "turn")
        changed = latest if changed is None else changed.unionAll(latest)
        # The groups that changed nodes join, and those that they leave, which may be of one family now.
        keys = cut_lineage(after.select("key").union(after.select(F.col("_key").alias("key"))).distinct())
        last = changed.groupBy("id").agg(F.max("turn").alias("_turn"))
        members = by_key.find(keys).join(dropped, "id", "left_anti").join(last, "id", "left")
        members = members.where(F.col("turn") == F.coalesce("_turn", F.lit(0))).drop("_turn")
        step = cut_lineage(remap_table(cut_lineage(members), "key", "id", family))
        if step.isEmpty():
            break
    return _resolved(steps)
