"""Contracts of the driver's tables, so that every operator runs on them as on the lab tables."""

from __future__ import annotations

from plantmart.contracts import Column, Contract, catalogue, flag, number, refers, text


def whole(name: str, required: bool = True) -> Column:
    return Column(name, "int", None, required)


def real(name: str, required: bool = True) -> Column:
    return Column(name, "double", None, required)


def moment(name: str) -> Column:
    return Column(name, "timestamp")


TEST_TABLES = catalogue(
    Contract("region", (whole("r_regionkey"), text("r_name", 50)), key=("r_regionkey",)),
    Contract(
        "nation",
        (whole("n_nationkey"), text("n_name", 50), whole("n_regionkey")),
        key=("n_nationkey",),
    ),
    Contract(
        "customer",
        (
            number("c_custkey"),
            text("c_name", 50),
            whole("c_nationkey"),
            real("c_acctbal"),
            text("c_mktsegment", 20),
        ),
        key=("c_custkey",),
    ),
    Contract(
        "supplier",
        (number("identity"), text("s_name", 50), whole("s_nationkey"), real("s_acctbal")),
        key=("identity",),
    ),
    Contract(
        "part",
        (
            number("p_partkey"),
            text("p_name", 100),
            text("p_brand", 20),
            text("p_type", 50),
            whole("p_size", required=False),
            real("p_retailprice"),
        ),
        key=("p_partkey",),
    ),
    Contract(
        "orders",
        (
            number("o_orderkey"),
            number("o_custkey"),
            flag("o_orderstatus"),
            real("o_totalprice"),
            moment("o_orderdate"),
            text("o_orderpriority", 50),
        ),
        key=("o_orderkey",),
        allowed=(("o_orderstatus", ("F",)),),
    ),
    Contract(
        "lineitem",
        (
            number("l_orderkey", required=False),
            number("l_partkey"),
            number("l_suppkey"),
            whole("l_linenumber"),
            real("l_quantity"),
            real("l_extendedprice"),
            real("l_discount"),
            real("l_tax"),
            flag("l_returnflag"),
            flag("l_linestatus"),
            moment("l_shipdate"),
        ),
        key=("l_orderkey", "l_linenumber"),
        references=(refers("l_orderkey", "orders", "o_orderkey"),),
    ),
    Contract(
        "documents",
        (
            number("doc_id"),
            text("text"),
            text("lang", 10),
            text("origin", 50),
            number("n_chars"),
        ),
        key=("doc_id",),
    ),
    Contract(
        "events",
        (
            number("event_id"),
            moment("ts"),
            number("user_id"),
            text("event_type", 20),
            real("value"),
            text("props"),
        ),
        key=("event_id",),
    ),
    Contract("pages", (number("page_id"), text("url", 500), text("html")), key=("page_id",)),
    Contract(
        "conversations",
        (number("conv_id"), number("turn"), text("role", 20), text("text")),
        key=("conv_id", "turn"),
    ),
)


def renamed(contract: Contract, name: str, extract: str) -> Contract:
    """The contract with one column read from another extract column."""
    columns = tuple(
        Column(c.name, c.kind, c.length, c.required, extract) if c.name == name else c
        for c in contract.columns
    )
    return Contract(contract.name, columns, contract.key, contract.references, contract.allowed)


def limited(contract: Contract, name: str, length: int) -> Contract:
    """The contract with another length for one text column."""
    columns = tuple(
        Column(c.name, c.kind, length, c.required, c.extract) if c.name == name else c
        for c in contract.columns
    )
    return Contract(contract.name, columns, contract.key, contract.references, contract.allowed)


def required(contract: Contract, name: str) -> Contract:
    columns = tuple(
        Column(c.name, c.kind, c.length, True, c.extract) if c.name == name else c
        for c in contract.columns
    )
    return Contract(contract.name, columns, contract.key, contract.references, contract.allowed)
