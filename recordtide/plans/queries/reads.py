"""The list-read surface over the sample orders."""

from pyspark.sql import functions as F

from recordtide.operators import read_api
from recordtide.operators.page_index import page_index
from recordtide.plans.registry import query
from recordtide.plans.standins import table
from recordtide.session import cut_lineage

_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
_SELECT = f"SELECT {', '.join(_COLUMNS)} FROM orders"


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*_COLUMNS)


@query("id_in_list", f"{_SELECT} WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def id_in_list(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    ids = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return read_api.id_in_list(orders(spark, sf_dir), ids, "o_orderkey")


@query(
    "id_sketch",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""",
)
def id_sketch(spark, sf_dir):
    """The lines of few, scattered orders, thinned out by a bit sketch of the ids before they meet them."""
    ids = orders(spark, sf_dir).where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    ids = cut_lineage(ids.select(F.col("o_orderkey").alias("l_orderkey")))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return read_api.id_in_list(lines, ids, "l_orderkey", unique=True, sketch_from=1)


@query(
    "page_index",
    f"{_SELECT} ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey LIMIT 700 OFFSET 9100",
)
def deep_page(spark, sf_dir):
    """Page 14 of 700 rows each, from rows sorted once."""
    return page_index(orders(spark, sf_dir), "-o_orderpriority,o_totalprice", "o_orderkey", range_rows=2000).page(14, 700)


@query(
    "op_filter",
    """SELECT o_orderkey,
              o_custkey < 50 AS is_lt, o_custkey <= 50 AS is_le, o_custkey > 50 AS is_gt, o_custkey >= 50 AS is_ge,
              o_custkey <> 50 AS is_ne, o_custkey BETWEEN 20 AND 40 AS is_between, o_custkey IN (1, 2, 3) AS is_in,
              o_custkey NOT IN (1, 2, 3) AS is_not_in
       FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') AND o_totalprice BETWEEN 1000 AND 400000""",
)
def op_filter(spark, sf_dir):
    key = F.col("o_custkey")
    kept = orders(spark, sf_dir).where(
        read_api.op_filter(F.col("o_orderpriority"), "!in", "5-LOW", "4-NOT SPECIFIED")
        & read_api.op_filter(F.col("o_totalprice"), "between", 1000, 400000)
    )
    return kept.select(
        "o_orderkey",
        *[read_api.op_filter(key, name, 50).alias(f"is_{name}") for name in ("lt", "le", "gt", "ge", "ne")],
        read_api.op_filter(key, "between", 20, 40).alias("is_between"),
        read_api.op_filter(key, "in", 1, 2, 3).alias("is_in"),
        read_api.op_filter(key, "!in", 1, 2, 3).alias("is_not_in"),
    )


@query(
    "search_match",
    """SELECT o_orderkey, o_orderstatus = 'F' AND o_custkey < 100 AS all_match,
              o_orderstatus = 'F' OR o_custkey < 100 AS any_match
       FROM orders WHERE o_orderstatus = 'F' OR o_custkey < 100""",
)
def search_match(spark, sf_dir):
    wanted = {"o_orderstatus": ("eq", "F"), "o_custkey": ("lt", 100)}
    both, either = read_api.search_match(wanted, "all"), read_api.search_match(wanted, "any")
    return orders(spark, sf_dir).where(either).select("o_orderkey", both.alias("all_match"), either.alias("any_match"))


@query("order_by", f"{_SELECT} ORDER BY o_orderpriority DESC, o_custkey, o_orderkey")
def order_by(spark, sf_dir):
    return read_api.order_by(orders(spark, sf_dir), "-o_orderpriority,o_custkey", "o_orderkey")


@query("limit", f"{_SELECT} ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit(spark, sf_dir):
    return read_api.limit(read_api.order_by(orders(spark, sf_dir), "-o_totalprice", "o_orderkey"), 100)


@query("paginate", f"{_SELECT} ORDER BY o_custkey, o_totalprice DESC, o_orderkey LIMIT 250 OFFSET 500")
def paginate(spark, sf_dir):
    return read_api.paginate(orders(spark, sf_dir), 3, 250, "o_custkey,-o_totalprice", "o_orderkey")


@query(
    "list_records",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' OR o_custkey >= 1000
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 50""",
)
def list_records(spark, sf_dir):
    return read_api.list_records(
        orders(spark, sf_dir), search={"o_orderstatus": ("eq", "F"), "o_custkey": ("ge", 1000)}, match="any",
        orderby="-o_totalprice", page=2, page_size=50, columns="o_orderkey,o_totalprice", key="o_orderkey",
    )


@query("paginate_after", f"{_SELECT} WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 250")
def paginate_after(spark, sf_dir):
    return read_api.paginate(orders(spark, sf_dir), 1, 250, ["o_orderkey"], "o_orderkey", after=100)


@query(
    "parse_search",
    """SELECT o_orderkey FROM orders
       WHERE o_custkey >= 20 AND o_custkey < 900 AND o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 1000 AND 200000""",
)
def parse_search(spark, sf_dir):
    """Several conditions on one column, in text form."""
    wanted = [("o_custkey", "ge(20)"), ("o_custkey", "lt", 900), ("o_orderstatus", "in(F, P)"), ("o_totalprice", "between(1000,200000)")]
    return orders(spark, sf_dir).where(read_api.search_match(wanted)).select("o_orderkey")
