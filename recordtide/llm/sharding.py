"""Shards of equal row counts that all hold the corpus' mixture of sources: proportional stratified interleaving.

Rows of one source are put in a seeded random order and ranked. Row ``r`` of a source of ``n`` rows stands at ``(r + u) / n``,
where ``u`` in [0, 1) is drawn per source by the seed, so that sources with fewer rows than there are shards do not all meet in
the same one. All rows are sorted by that number and the sorted list is cut into pieces of equal length, at most one row apart.

Both ranks are taken from sorts by range: rows are dealt to tasks by range of the whole sort key, each task numbers its own, and
the numbers of rows in the ranges before are added, of which there is one per task and source in it. So a source with most of
the rows is spread over many tasks, and no task sees more than its range. Only narrow rows are sorted, unless texts are asked for.

The random order depends on seed and ``doc_id``; rows of one id are ordered by checksum and size of the text, and rows equal in
these too by their place in the input. A null text has no bytes, a null id is ordered like an empty one, a null source is a
source of its own. Other columns are ignored, or come along by ``carry``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtide.llm.tables import cut_lineage, small

SHARDS = 40
SEED = 20_240_613
#: Counted into each row's size beside its text.
OVERHEAD = 16
#: A partition's number stands above these bits in ``monotonically_increasing_id``, the row's place in it below.
_PLACE_BITS = 33


def drawn(seed: int, value: Column) -> Column:
    """60 random bits that depend on ``seed`` and a text alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 15), 16, 10).cast("long")


def _sorted(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``range`` and ``place``: the rows' range in a global sort, and their place in that."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    at = F.col("__at")
    return cut_lineage(
        dealt.withColumns({"__range": F.shiftright(at, _PLACE_BITS), "__place": at.bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("__at")
    )


def _ahead(counts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Rows in the ranges before each range."""
    out, total = [], 0
    for key, n in sorted(counts):
        out.append((key, total))
        total += n
    return out


def assign(docs: DataFrame, shards: int = SHARDS, by: str = "source", seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row, and the columns of ``carry`` as one struct ``carried``."""
    spark = docs.sparkSession
    text, doc_id = docs["text"].cast("string"), docs["doc_id"].cast("long")
    carried = [F.struct(*[docs[f"`{name}`"].alias(name) for name in carry]).alias("__carried")] if carry else []
    keyed = cut_lineage(
        docs.select(
            doc_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.concat(F.lit("="), docs[f"`{by}`"].cast("string")), F.lit("")).alias("__stratum"),
            drawn(seed, F.coalesce(doc_id.cast("string"), F.lit(""))).alias("__drawn"),
            F.monotonically_increasing_id().alias("__row"), *carried,
        )
    )
    ranked = _sorted(keyed, ["__stratum", "__drawn", "doc_id", "text_crc32", "size", "__row"])
    # One row per range and source in it. Its rows lie side by side, from the least place on.
    runs = cut_lineage(ranked.groupBy("__stratum", "__range").agg(F.count("*").alias("n"), F.min("__place").alias("first")))
    whole = Window.partitionBy("__stratum")
    before = F.sum("n").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__shift")
    shifts = cut_lineage(runs.select("__stratum", "__range", shift, F.sum("n").over(whole).alias("__n")))
    ranked = ranked.join(small(shifts), ["__stratum", "__range"])
    rank = F.col("__place") + F.col("__shift")
    start = (drawn(seed, F.col("__stratum")) / F.lit(float(1 << 60))).cast("double")
    placed = ranked.select(
        "doc_id", "size", "text_crc32", "__stratum", rank.alias("__rank"), ((rank + start) / F.col("__n")).alias("__fraction"), *(["__carried"] if carry else [])
    )
    merged = _sorted(cut_lineage(placed), ["__fraction", "__stratum", "__rank"])
    counts = [(r["__range"], r["n"]) for r in merged.groupBy("__range").agg(F.count("*").alias("n")).collect()]  # one per task
    total = sum(n for _, n in counts)
    ahead = spark.createDataFrame(_ahead(counts), "__range long, __ahead long")
    position = F.col("__place") + F.col("__ahead")
    shard = F.expr(f"(__position * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    numbered = merged.join(F.broadcast(ahead), "__range").withColumn("__position", position).withColumn("shard", shard)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("__position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *([F.col("__carried").alias("carried")] if carry else []),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, by: str = "source", seed: int = SEED) -> None:
    """Write whole documents to ``folder/shard=K``, each shard's rows in the order of their slots.

    A shard may be written by several tasks, as its size grows with the corpus; file names follow the slots. Columns of the
    documents that are named ``shard`` or ``slot`` are written with ``_in`` behind their names.
    """
    spread = assign(docs, shards, by, seed, carry=docs.columns)
    own = [F.col("carried")[name].alias(f"{name}_in" if name in ("shard", "slot") else name) for name in docs.columns]
    spread.select("shard", "slot", *own).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


#: The same in SQL, for tables with a ``source`` column. CRC-32 goes byte by byte over the text's hexadecimal digits.
SQL = f"""
WITH digits AS (
    SELECT i, list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i)
), crc AS (SELECT list(v ORDER BY i) AS t FROM digits),
keyed AS (
    SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + {OVERHEAD} AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
        ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS drawn,
        ('0x' || substr(md5('{SEED}:' || coalesce('=' || source, '')), 1, 15))::BIGINT / {float(1 << 60)}::DOUBLE AS start,
        coalesce('=' || source, '') AS stratum
    FROM documents, crc
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY drawn, doc_id NULLS FIRST, text_crc32, size) - 1 AS r,
        count(*) OVER (PARTITION BY stratum) AS n
    FROM keyed
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (r + start) / n, stratum, r) - 1 AS p, count(*) OVER () AS total FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (p * {SHARDS} // total)::INT AS shard,
    p - ((p * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INT AS grown_shard
FROM placed
"""
