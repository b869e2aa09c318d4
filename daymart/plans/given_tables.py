"""Columns of all given tables, by the kind of summary that tells their content."""

from __future__ import annotations

WHOLE, REAL, TEXT, MOMENT, VECTOR = "whole", "real", "text", "moment", "vector"

TABLES: dict[str, dict[str, str]] = {
    "region": {"r_regionkey": WHOLE, "r_name": TEXT},
    "nation": {"n_nationkey": WHOLE, "n_name": TEXT, "n_regionkey": WHOLE},
    "customer": {"c_custkey": WHOLE, "c_name": TEXT, "c_nationkey": WHOLE, "c_acctbal": REAL, "c_mktsegment": TEXT},
    "supplier": {"s_suppkey": WHOLE, "s_name": TEXT, "s_nationkey": WHOLE, "s_acctbal": REAL},
    "part": {"p_partkey": WHOLE, "p_name": TEXT, "p_brand": TEXT, "p_type": TEXT, "p_size": WHOLE, "p_retailprice": REAL},
    "orders": {
        "o_orderkey": WHOLE,
        "o_custkey": WHOLE,
        "o_orderstatus": TEXT,
        "o_totalprice": REAL,
        "o_orderdate": MOMENT,
        "o_orderpriority": TEXT,
    },
    "lineitem": {
        "l_orderkey": WHOLE,
        "l_partkey": WHOLE,
        "l_suppkey": WHOLE,
        "l_linenumber": WHOLE,
        "l_quantity": REAL,
        "l_extendedprice": REAL,
        "l_discount": REAL,
        "l_tax": REAL,
        "l_returnflag": TEXT,
        "l_linestatus": TEXT,
        "l_shipdate": MOMENT,
    },
    "events": {"event_id": WHOLE, "ts": MOMENT, "user_id": WHOLE, "event_type": TEXT, "value": REAL, "props": TEXT},
    "documents": {"doc_id": WHOLE, "text": TEXT, "lang": TEXT, "source": TEXT, "n_chars": WHOLE},
    "embeddings": {"vec_id": WHOLE, "embedding": VECTOR, "label": WHOLE},
    "pages": {"page_id": WHOLE, "url": TEXT, "html": TEXT},
    "benchmark": {"item_id": WHOLE, "text": TEXT},
    "labels": {"doc_id": WHOLE, "quality": WHOLE, "toxic": WHOLE},
    "conversations": {"conv_id": WHOLE, "turn": WHOLE, "role": TEXT, "text": TEXT},
}
