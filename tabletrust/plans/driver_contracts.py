"""Contracts for the driver's test tables (keys, references, domains).

Fixed values: the TPC-H domains below (market segments, order
priorities, order status O/F/P, return flag A/N/R, line status O/F),
the event types click/error/purchase/signup/view and the roles
user/assistant/system, as found in the tables.
"""

from __future__ import annotations

from tabletrust.contract import Col, ForeignKey, Implies, TableContract

REGION = TableContract(
    "region",
    (Col("r_regionkey", "int", False), Col("r_name", "string", False)),
    primary_key=("r_regionkey",),
)
NATION = TableContract(
    "nation",
    (Col("n_nationkey", "int", False), Col("n_name", "string", False), Col("n_regionkey", "int", False)),
    primary_key=("n_nationkey",),
    foreign_keys=(ForeignKey(("n_regionkey",), "region", ("r_regionkey",)),),
)
CUSTOMER = TableContract(
    "customer",
    (
        Col("c_custkey", "bigint", False),
        Col("c_name", "string", False, max_length=25),
        Col("c_nationkey", "int", False),
        Col("c_acctbal", "double"),
        Col("c_mktsegment", "string", domain=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    ),
    primary_key=("c_custkey",),
    foreign_keys=(ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),),
)
SUPPLIER = TableContract(
    "supplier",
    (
        Col("s_suppkey", "bigint", False),
        Col("s_name", "string", False, max_length=25),
        Col("s_nationkey", "int", False),
        Col("s_acctbal", "double"),
    ),
    primary_key=("s_suppkey",),
    foreign_keys=(ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),),
)
PART = TableContract(
    "part",
    (
        Col("p_partkey", "bigint", False),
        Col("p_name", "string", False, max_length=55),
        Col("p_brand", "string", max_length=10),
        Col("p_type", "string", max_length=25),
        Col("p_size", "int", lo=1, hi=50),
        Col("p_retailprice", "double", lo=0),
    ),
    primary_key=("p_partkey",),
)
ORDERS = TableContract(
    "orders",
    (
        Col("o_orderkey", "bigint", False),
        Col("o_custkey", "bigint", False),
        Col("o_orderstatus", "string", False, domain=("O", "F", "P")),
        Col("o_totalprice", "double", lo=0),
        Col("o_orderdate", "timestamp_ntz", False),
        Col("o_orderpriority", "string", domain=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
    ),
    primary_key=("o_orderkey",),
    foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),),
)
LINEITEM = TableContract(
    "lineitem",
    (
        Col("l_orderkey", "bigint", False),
        Col("l_partkey", "bigint", False),
        Col("l_suppkey", "bigint", False),
        Col("l_linenumber", "int", False, lo=1, hi=7),
        Col("l_quantity", "double", lo=1, hi=50),
        Col("l_extendedprice", "double", lo=0),
        Col("l_discount", "double", lo=0.0, hi=0.10),
        Col("l_tax", "double", lo=0.0, hi=0.08),
        Col("l_returnflag", "string", domain=("A", "N", "R")),
        Col("l_linestatus", "string", domain=("O", "F")),
        Col("l_shipdate", "timestamp_ntz"),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
    foreign_keys=(
        ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        ForeignKey(("l_partkey",), "part", ("p_partkey",)),
        ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)),
    ),
    implies=(Implies("returned_is_final", "l_returnflag = 'R'", "l_linestatus = 'F'"),),
)
EVENTS = TableContract(
    "events",
    (
        Col("event_id", "bigint", False),
        Col("ts", "timestamp_ntz", False),
        Col("user_id", "bigint", False),
        Col("event_type", "string", False, domain=("click", "error", "purchase", "signup", "view")),
        Col("value", "double"),
        Col("props", "string"),
    ),
    primary_key=("event_id",),
    implies=(Implies("props_is_json", "props IS NOT NULL", "try_parse_json(props) IS NOT NULL"),),
)
DOCUMENTS = TableContract(
    "documents",
    (
        Col("doc_id", "bigint", False),
        Col("text", "string"),
        Col("lang", "string"),
        Col("source", "string"),
        Col("n_chars", "bigint", lo=0),
    ),
    primary_key=("doc_id",),
    implies=(Implies("n_chars_is_length", "text IS NOT NULL", "n_chars = char_length(text)"),),
)
LABELS = TableContract(
    "labels",
    (Col("doc_id", "bigint", False), Col("quality", "int", domain=(0, 1)), Col("toxic", "int", domain=(0, 1))),
    primary_key=("doc_id",),
    foreign_keys=(ForeignKey(("doc_id",), "documents", ("doc_id",)),),
)
EMBEDDINGS = TableContract(
    "embeddings",
    (Col("vec_id", "bigint", False), Col("embedding", "array<float>"), Col("label", "int")),
    primary_key=("vec_id",),
)
PAGES = TableContract(
    "pages",
    (Col("page_id", "bigint", False), Col("url", "string"), Col("html", "string")),
    primary_key=("page_id",),
)
BENCHMARK = TableContract(
    "benchmark", (Col("item_id", "bigint", False), Col("text", "string")), primary_key=("item_id",)
)
CONVERSATIONS = TableContract(
    "conversations",
    (
        Col("conv_id", "bigint", False),
        Col("turn", "bigint", False, lo=0),
        Col("role", "string", domain=("user", "assistant", "system")),
        Col("text", "string"),
    ),
    primary_key=("conv_id", "turn"),
)

DRIVER_CONTRACTS = {
    c.name: c
    for c in (
        REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDERS, LINEITEM, EVENTS,
        DOCUMENTS, LABELS, EMBEDDINGS, PAGES, BENCHMARK, CONVERSATIONS,
    )
}
