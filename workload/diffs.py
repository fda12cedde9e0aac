"""Frame, array and snapshot comparison, fingerprints, versions, lineage."""

from pyspark.sql import functions as F

from docledger.operators.framediff import frame_diff, narrowed, shape_counts, side_by_side
from docledger.operators.lineage import Project, downstream, trace, upstream
from docledger.operators.snapshots import (
    file_hashes,
    fingerprint,
    latest_version,
    read_version,
    snapshot_diff,
    versions,
    write_version,
)
from workload.base import query

_FIELDS = ("o_custkey", "o_orderstatus", "total", "order_date", "o_orderpriority")


def _cells(joined: str, align: str, fields, more: str = "") -> str:
    return " union all ".join(
        f"select {align}, '{c}' as \"column\", cast(a.{c} as varchar) as left_value,"
        f" cast(b.{c} as varchar) as right_value from {joined} where a.{c} is distinct from b.{c}{more}"
        for c in fields
    )


_BY_KEY = "{orders_old} a join {orders_new} b on a.o_orderkey = b.o_orderkey"


@query("frame_diff_key", _cells(_BY_KEY, "a.o_orderkey", _FIELDS))
def _frame_diff_key(t):
    return frame_diff(t("orders_old"), t("orders_new"), key=["o_orderkey"])


@query("frame_diff_ignore", _cells(_BY_KEY, "a.o_orderkey", [c for c in _FIELDS if c != "total"]))
def _frame_diff_ignore(t):
    return frame_diff(t("orders_old"), t("orders_new"), key=["o_orderkey"], ignore=["total"])


def _placed(view: str) -> str:
    return f"(select *, row_number() over (order by total, o_orderkey) as position from {{{view}}})"


@query(
    "frame_diff_select",
    _cells(
        f"{_placed('orders_old')} a full join {_placed('orders_new')} b on a.position = b.position",
        "coalesce(a.position, b.position) as position",
        ["o_orderstatus", "total"],
        " or a.position is null or b.position is null",
    ),
)
def _frame_diff_select(t):
    return frame_diff(
        t("orders_old"), t("orders_new"), order_by=["total", "o_orderkey"], include=["o_orderstatus", "total"]
    )


@query(
    "frame_shape",
    """
    select (select count(*) from {orders_old}) as left_rows, (select count(*) from {cus}) as right_rows,
        cast(3 as bigint) as left_columns, cast(12 as bigint) as right_columns,
        (select string_agg(c, ',' order by c) from (
            (select unnest(['o_orderkey', 'o_custkey', 'total']) as c except select column_name from (describe select * from {cus}))
            union all
            (select column_name from (describe select * from {cus}) except select unnest(['o_orderkey', 'o_custkey', 'total']))
        )) as header_difference
    """,
)
def _frame_shape(t):
    left = narrowed(t("orders_old"), ["o_orderkey", "o_custkey", "total"], None)
    return shape_counts(left, t("cus"))


@query(
    "frame_diff_repeated_key",
    """
    with l as (select doc_no, l_partkey, l_suppkey, sgst, taxable, row_number() over (
            partition by doc_no order by l_linenumber, l_partkey, l_suppkey, l_quantity, taxable) as ordinal from {gen}),
    r as (select doc_no, l_partkey, l_suppkey, sgst, taxable, row_number() over (
            partition by doc_no order by l_linenumber, l_partkey, l_suppkey, l_quantity, taxable) as ordinal from {cus})
    select l.doc_no, l.ordinal, 'sgst' as "column", cast(l.sgst as varchar) as left_value,
        cast(r.sgst as varchar) as right_value
    from l join r on l.doc_no = r.doc_no and l.ordinal = r.ordinal where l.sgst is distinct from r.sgst
    """,
)
def _frame_diff_repeated_key(t):
    return frame_diff(
        t("gen"),
        t("cus"),
        key=["doc_no"],
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "taxable"],
        include=["doc_no", "sgst"],
    )


def _other_embeddings(t):
    """The same vectors: some reversed, some with a part zeroed, some gone."""
    vector = (
        F.when(F.col("label") == 1, F.reverse("embedding"))
        .when(F.col("label") == 2, F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(0).cast("float")).otherwise(x)))
        .when(F.col("label") == 3, F.lit(None))
        .otherwise(F.col("embedding"))
    )
    return t("embeddings").select("vec_id", vector.alias("embedding"))


_OTHER = """
    select vec_id, embedding as a, case label when 1 then list_reverse(embedding)
        when 2 then list_concat(embedding[1:3], [cast(0 as float)], embedding[5:]) when 3 then null
        else embedding end as b
    from {embeddings}
"""


@query("array_diff_ordered", f"select vec_id, 'embedding' as \"column\" from ({_OTHER}) where a is distinct from b")
def _array_diff_ordered(t):
    diff = frame_diff(t("embeddings").select("vec_id", "embedding"), _other_embeddings(t), key=["vec_id"])
    return diff.select("vec_id", "column")


@query(
    "array_diff_unordered",
    f"select vec_id, 'embedding' as \"column\" from ({_OTHER}) where list_sort(a) is distinct from list_sort(b)",
)
def _array_diff_unordered(t):
    diff = frame_diff(
        t("embeddings").select("vec_id", "embedding"), _other_embeddings(t), key=["vec_id"], ordered_arrays=False
    )
    return diff.select("vec_id", "column")


_PAIR_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, taxable"


def _half(view: str, prefix: str) -> str:
    return f"""select doc_no as k, row_number() over (partition by doc_no order by {_PAIR_ORDER}) as ordinal,
        doc_no as {prefix}doc_no, l_partkey as {prefix}l_partkey, doc_date as {prefix}doc_date,
        cast(taxable as double) as {prefix}taxable from {{{view}}}"""


@query(
    "side_by_side",
    f"""
    select a.k as "Key", a.ordinal, a.* exclude (k, ordinal), b.* exclude (k, ordinal)
    from ({_half("gen", "left_")}) a join ({_half("cus", "right_")}) b on a.k = b.k and a.ordinal = b.ordinal
    """,
)
def _side_by_side(t):
    pairs = side_by_side(t("gen"), t("cus"), "doc_no", _PAIR_ORDER.split(", "))
    shown = ("doc_no", "l_partkey", "doc_date", "taxable")
    return pairs.select("Key", "ordinal", *[f"{p}_{c}" for p in ("left", "right") for c in shown])


@query(
    "snapshot_diff",
    f"""
    select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
        case when a.o_orderkey is null then 'Added' when b.o_orderkey is null then 'Removed' else 'Modified' end as change
    from {{orders_old}} a full join {{orders_new}} b on a.o_orderkey = b.o_orderkey
    where a.o_orderkey is null or b.o_orderkey is null
        or {" or ".join(f"a.{c} is distinct from b.{c}" for c in _FIELDS)}
    """,
)
def _snapshot_diff(t):
    return snapshot_diff(t("orders_old"), t("orders_new"), ["o_orderkey"])


_ORDER_COLUMNS = ("o_orderkey", *_FIELDS)


def _fingerprint_sql(view: str) -> str:
    cells = " || ".join(
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '~')" for c in _ORDER_COLUMNS
    )
    sums = " || ':' || ".join(
        f"cast(sum(cast('0x' || substr(d, {8 * i + 1}, 8) as bigint)) as varchar)" for i in range(4)
    )
    return f"""
    select count(*) as row_count, md5(cast(count(*) as varchar) || ':' || {sums}) as fingerprint
    from (select md5({cells}) as d from {{{view}}})
    """


@query("fingerprint", _fingerprint_sql("orders_new"))
def _fingerprint(t):
    return fingerprint(t("orders_new"))


@query(
    "version_latest",
    """
    select max(version) as version, arg_max(file_hash, version) as file_hash from {version_log}
    """,
)
def _version_latest(t):
    return latest_version(t("version_log"))


_BLOCK = 1_000  # lines a block, small enough for trees of several levels


def _level(below: str) -> str:
    return f"""select part, n // {_BLOCK} as n, case when n // {_BLOCK} = 0 and count(*) = 1 then min(digest)
        else md5(string_agg(digest, '' order by n)) end as digest from {below} group by part, n // {_BLOCK}"""


@query(
    "versioned_write",
    """
    select cast(2 as bigint) as versions, o_orderkey, o_custkey, o_orderstatus, cast(total as double) as total,
        order_date, o_orderpriority
    from {orders_new}
    """,
)
def _versioned_write(t):
    root = t.scratch()
    write_version(t("orders_old"), root, "first", "user")
    write_version(t("orders_new"), root, "second", "user")
    write_version(t("orders_new"), root, "unchanged", "user")
    written = versions(t.spark, root).count()
    return read_version(t.spark, root).select(F.lit(written).cast("long").alias("versions"), *_ORDER_COLUMNS)


@query(
    "file_fingerprints",
    f"""
    with lines as (
        select o_orderpriority as part, row_number() over (partition by o_orderpriority order by o_orderkey) - 1 as n,
            concat_ws('|', o_orderkey, o_custkey, o_orderstatus) as line
        from {{orders}}
    ), leaves as (
        select part, n, md5(line) as digest from lines
    ), one as ({_level("leaves")}), two as ({_level("one")}), three as ({_level("two")})
    select part, md5(concat_ws(':', size, digest)) as hash
    from (select part, cast(sum(length(line) + 1) as bigint) as size from lines group by 1) join three using (part)
    """,
)
def _file_fingerprints(t):
    """One text file per priority, written from the orders and fingerprinted by blocks."""
    root = f"{t.scratch()}/files"
    lines = t("orders").select(
        "o_orderpriority", "o_orderkey", F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus").alias("value")
    )
    laid = lines.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority", "o_orderkey")
    laid.select("value", F.col("o_orderpriority").alias("part")).write.partitionBy("part").text(root)
    hashes = file_hashes(t.spark, root, block_lines=_BLOCK)
    part = F.url_decode(F.regexp_extract("path", "part=([^/]*)/", 1))
    return hashes.select(part.alias("part"), "hash")


@query(
    "lineage_closure",
    """
    with recursive walk(start, node, depth) as (
        select node, node, 0 from {starts}
        union all
        select w.start, e.parent, w.depth + 1 from walk w join {edges} e on e.child = w.node)
    select start, node, min(depth) as depth from walk group by 1, 2
    """,
)
def _lineage_closure(t):
    return upstream(t("edges"), t("starts"))


@query(
    "lineage_downstream",
    """
    with recursive walk(start, node, depth) as (
        select node, node, 0 from {starts}
        union all
        select w.start, e.child, w.depth + 1 from walk w join {edges} e on e.parent = w.node)
    select start, node, min(depth) as depth from walk group by 1, 2
    """,
)
def _lineage_downstream(t):
    return downstream(t("edges"), t("starts"))


_WANTED = "select lpad(cast(o_orderkey as string), 10, '0') from {orders} where o_orderpriority = '1-URGENT'"


@query(
    "manifest_downstream",
    """
    select 'model.s' || s_suppkey as node, 'layer.' || s_name as "table", 2 as depth
    from {supplier} join {nation} on s_nationkey = n_nationkey where n_regionkey in (1, 3)
    union all
    select 'model.n' || n_nationkey, 'layer.' || n_name, 1 from {nation} where n_regionkey in (1, 3)
    union all
    select 'source.r' || r_regionkey, 'raw.' || r_name, 0 from {region} where r_regionkey in (1, 3)
    """,
)
def _manifest_downstream(t):
    """A project's manifest, read from its file: what is built from two of its sources."""
    path = f"{t.scratch()}/manifest"
    models = t("supplier").select(
        F.concat(F.lit("model.s"), "s_suppkey").alias("node"), F.col("s_name").alias("name"),
        F.concat(F.lit("model.n"), "s_nationkey").alias("parent"),
    ).unionByName(
        t("nation").select(
            F.concat(F.lit("model.n"), "n_nationkey").alias("node"), F.col("n_name").alias("name"),
            F.concat(F.lit("source.r"), "n_regionkey").alias("parent"),
        )
    )
    raw = t("region").select(F.concat(F.lit("source.r"), "r_regionkey").alias("node"), F.col("r_name").alias("name"))

    def entries(df, schema):
        of = F.struct(F.lit(schema).alias("schema"), "name")
        return df.agg(F.map_from_entries(F.collect_list(F.struct("node", of))).alias("m"))

    parents = models.agg(F.map_from_entries(F.collect_list(F.struct("node", F.array("parent")))).alias("p"))
    nodes, sources = entries(models, "layer"), entries(raw, "raw").withColumnRenamed("m", "s")
    whole = nodes.join(F.broadcast(sources)).join(F.broadcast(parents))
    whole.select(F.to_json(F.struct(F.col("m").alias("nodes"), F.col("s").alias("sources"), F.col("p").alias("parent_map")))).write.text(path)
    project = Project.from_manifest(t.spark.read.text(path, wholetext=True).where("value <> ''").first()[0])
    starts = t("region").where("r_regionkey in (1, 3)").select(F.concat(F.lit("source.r"), "r_regionkey").alias("node"))
    names = t.spark.createDataFrame(list(project.tables.items()), "node string, table string")
    return downstream(project.edges(t.spark), starts).join(names, "node").select("node", "table", "depth")


@query(
    "trace_rows",
    f"""
    select 's_sale.billing' as "table", 0 as visit, 0 as depth,
        cast(json_object('VBELN', belnr, 'AWKEY', awkey, 'blart', blart) as varchar) as "row" from {{bkpf}}
    where belnr in ({_WANTED}) or awkey in ({_WANTED})
    union all
    select 's_sale.ledger', 1, 1, cast(json_object('BELNR', belnr, 'hkont', hkont, 'sgtxt', sgtxt) as varchar) from {{bseg}}
    where belnr in ({_WANTED})
    union all
    select 'raw.accounts', 2, 2, cast(json_object('saknr', saknr, 'txt50', txt50) as varchar) from {{skat}}
    """,
)
def _trace_rows(t):
    tables = {
        "s_sale.billing": t("bkpf").select(
            F.col("belnr").alias("VBELN"), F.col("awkey").alias("AWKEY"), "blart"
        ),
        "s_sale.ledger": t("bseg").select(F.col("belnr").alias("BELNR"), "hkont", "sgtxt"),
        "raw.accounts": t("skat").select("saknr", "txt50"),
    }
    parents = {"s_sale.billing": ["s_sale.ledger", "raw.accounts"], "s_sale.ledger": ["raw.accounts"]}
    urgent = t("orders").where("o_orderpriority = '1-URGENT'")
    numbers = urgent.select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("number"))
    return trace(tables, parents, "s_sale.billing", numbers)
