"""Voucher operators over a frame of document keys (one key is the small case).

Master tables (accounts, texts, partners) carry no broadcast hint: the planner
broadcasts them while their measured size allows and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import (
    debit_credit,
    named,
    rjust_key,
    rounded_amount,
    stripped,
    suffix_match,
    value_text,
)
from docledger.operators.joins import look_up, members
from docledger.operators.ordering import with_ordinal
from docledger.operators.rollup import first_per_key

# Document key, searched ids, and the header columns on show.
DOC_KEY = ("bukrs", "gjahr", "belnr")
SEARCH_IDS = ("belnr", "awkey", "xblnr")
SEARCH_COLUMNS = ("bukrs", "gjahr", "belnr", "awkey", "xblnr", "blart")
HEADER_COLUMNS = (
    "bukrs", "gjahr", "awkey", "awtyp", "belnr", "blart", "xblnr", "budat",
    "bldat", "cpudt", "xreversal", "tcode", "usnam",
)
LEDGER_COLUMNS = (
    "buzei", "koart", "buzid", "txgrp", "shkzg", "mwskz", "ktosl", "hkont", "txt50",
    "sgtxt", "rebzg", "rebzj", "dmbtr_debit", "dmbtr_credit", "bupla", "werks",
    "prctr", "lifnr", "kunnr", "gst_part", "hsn_sac",
)
LANGUAGE = "E"


def first_available(spark: SparkSession, names: Sequence[str]) -> str:
    """The first table of ``names`` that exists; the last one when none does."""
    return next((n for n in names if spark.catalog.tableExists(n)), names[-1])


def pick(df: DataFrame, keys: DataFrame | None, columns: Sequence[str] = DOC_KEY) -> DataFrame:
    """Rows of the wanted documents; all rows when no keys are given."""
    if keys is None:
        return df
    return members(df, keys, columns)


# --- search -----------------------------------------------------------------


def search(headers: DataFrame, types: Sequence[str], number: str) -> DataFrame:
    """Documents of ``types`` with an id ending in ``number``; an empty number finds all."""
    return _typed(headers, types).where(suffix_match(SEARCH_IDS, number))


def sample_documents(headers: DataFrame, types: Sequence[str], limit: int) -> DataFrame:
    """A repeatable sample of ``limit`` documents of ``types``."""
    return repeatable_sample(_typed(headers, types), DOC_KEY, limit)


def _typed(headers: DataFrame, types: Sequence[str]) -> DataFrame:
    return headers.where(F.col("blart").isin(*types)).select(*SEARCH_COLUMNS)


def repeatable_sample(df: DataFrame, key: Sequence[str], limit: int) -> DataFrame:
    """``limit`` rows in order of a hash of their key: the same rows on every run."""
    text = F.concat_ws("|", *[named(c).cast("string") for c in key])
    return df.orderBy(F.md5(text), *[named(c) for c in key]).limit(limit)


def search_many(headers: DataFrame, numbers: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Suffix search for a whole frame of numbers (column ``number``, taken literally).

    Each id is cut to the lengths that occur among the numbers, which turns the
    suffix test into an equi-join. Rows are (number, document), each pair once.
    """
    wanted = numbers.select("number").where(F.length("number") > 0)
    # At most one entry per possible identifier length.
    lengths = wanted.agg(F.sort_array(F.collect_set(F.length("number")))).first()[0]
    typed = headers if types is None else headers.where(F.col("blart").isin(*types))
    typed = typed.select(*SEARCH_COLUMNS)
    if not lengths:
        return typed.select(F.lit("").alias("number"), *SEARCH_COLUMNS).where(F.lit(False))
    cuts = [
        F.when(F.length(c) >= n, F.right(F.col(c), F.lit(n))) for c in SEARCH_IDS for n in lengths
    ]
    ends = F.array_distinct(F.array_compact(F.array(*cuts)))
    return members(typed.select(F.explode(ends).alias("number"), *SEARCH_COLUMNS), wanted, ["number"])


def search_outcome(numbers: DataFrame, matches: DataFrame) -> DataFrame:
    """none / one / many documents found per number."""
    found = matches.groupBy("number").agg(F.count(F.lit(1)).alias("documents"))
    status = F.when(F.col("documents") == 0, "none").when(F.col("documents") == 1, "one").otherwise("many")
    return (
        numbers.select("number").distinct().join(found, "number", "left")
        .withColumn("documents", F.coalesce("documents", F.lit(0).cast("long")))
        .withColumn("outcome", status)
    )


def header(headers: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    return pick(headers, keys).select(*HEADER_COLUMNS)


# --- ledger and tax lines ---------------------------------------------------


def with_account_text(
    lines: DataFrame, companies: DataFrame, accounts: DataFrame, language: str = LANGUAGE, require_text: bool = False
) -> DataFrame:
    """Add ``txt50`` by company chart of accounts, account and language.

    The language is part of the join, so lines without a text stay unless
    ``require_text`` asks to drop them.
    """
    charts = companies.select(F.col("bukrs").alias("__bukrs"), F.col("ktopl").alias("__ktopl"))
    texts = accounts.where(F.col("spras") == language).select(
        F.col("saknr").alias("__saknr"), F.col("ktopl").alias("__text_ktopl"), "txt50"
    )
    charted = lines.join(charts, lines["bukrs"] == charts["__bukrs"], "left")
    joined = charted.join(
        texts,
        (charted["hkont"] == texts["__saknr"]) & (charted["__ktopl"] == texts["__text_ktopl"]),
        "inner" if require_text else "left",
    )
    return joined.drop("__bukrs", "__ktopl", "__saknr", "__text_ktopl")


def ledger_lines(
    lines: DataFrame,
    companies: DataFrame,
    accounts: DataFrame,
    keys: DataFrame | None = None,
    language: str = LANGUAGE,
    factor: float = 1.0,
    require_text: bool = False,
) -> DataFrame:
    """Ledger lines with account text and separate debit and credit columns."""
    texted = with_account_text(pick(lines, keys), companies, accounts, language, require_text)
    sided = texted.withColumn(
        "dmbtr_debit", debit_credit(F.col("shkzg"), F.col("dmbtr"), "S", factor)
    ).withColumn("dmbtr_credit", debit_credit(F.col("shkzg"), F.col("dmbtr"), "H", factor))
    return sided.select(*DOC_KEY, *[c for c in LEDGER_COLUMNS if c in sided.columns])


def ledger_order(ledger: DataFrame) -> DataFrame:
    """Documents in key order, debits before credits, lines ascending."""
    return ledger.orderBy(*DOC_KEY, F.col("shkzg").desc_nulls_last(), F.col("buzei").asc_nulls_last())


def tax_lines(
    lines: DataFrame,
    accounts: DataFrame,
    keys: DataFrame | None = None,
    language: str = LANGUAGE,
    factor: float = 1.0,
) -> DataFrame:
    """Tax lines with account text by account and language alone; an account
    texted in several charts repeats its line."""
    texts = accounts.where(F.col("spras") == language).select(F.col("saknr").alias("hkont"), "txt50")
    scaled = [
        (F.col(c).cast("float").cast("double") / F.lit(float(factor))).alias(c)
        for c in ("hwbas", "hwste", "kbetr")
    ]
    return (
        pick(lines, keys)
        .join(texts, "hkont", "left")
        .select(*DOC_KEY, "buzei", "kschl", "ktosl", "txgrp", "mwskz", "hkont", "txt50", *scaled)
    )


def tax_order(taxes: DataFrame) -> DataFrame:
    """Documents in key order, lines ascending."""
    return taxes.orderBy(*DOC_KEY, F.col("buzei").asc_nulls_last())


def tax_codes(
    ledger: DataFrame, taxes: DataFrame, code_texts: DataFrame, procedure: str, language: str = LANGUAGE
) -> DataFrame:
    """Texts of the tax codes each document uses in its ledger or tax lines."""
    columns = [*DOC_KEY, "mwskz"]
    used = ledger.select(*columns).unionByName(taxes.select(*columns)).distinct()
    texts = code_texts.where((F.col("spras") == language) & (F.col("kalsm") == procedure))
    return used.join(texts.select("mwskz", "text1"), "mwskz").select(*columns, "text1")


def ledger_summary(
    lines: DataFrame,
    companies: DataFrame,
    accounts: DataFrame,
    keys: DataFrame | None = None,
    language: str = LANGUAGE,
    factor: float = 1.0,
) -> DataFrame:
    """Debit and credit sums per document and account.

    Lines are summed per account before the text is looked up, so the texts
    meet the sums and not every line.
    """
    sums = (
        pick(lines, keys)
        .groupBy(*DOC_KEY, "hkont")
        .agg(
            F.sum(debit_credit(F.col("shkzg"), F.col("dmbtr"), "S", factor, 0.0)).alias("debit"),
            F.sum(debit_credit(F.col("shkzg"), F.col("dmbtr"), "H", factor, 0.0)).alias("credit"),
        )
    )
    texted = with_account_text(sums, companies, accounts, language)
    return texted.groupBy(*DOC_KEY, "hkont", "txt50").agg(
        F.sum("debit").cast("float").alias("dmbtr_debit_sum"),
        F.sum("credit").cast("float").alias("dmbtr_credit_sum"),
    )


def summary_order(summary: DataFrame) -> DataFrame:
    """Accounts of a document by the sum of both sides, smallest first."""
    return summary.orderBy(*DOC_KEY, F.col("dmbtr_debit_sum") + F.col("dmbtr_credit_sum"))


# --- billing and pricing ----------------------------------------------------


def billing_keys(headers: DataFrame) -> DataFrame:
    """Billing numbers the documents refer to, with the document they belong to."""
    return headers.select(*DOC_KEY, F.col("awkey").alias("vbeln")).where(F.col("vbeln").isNotNull())


def billing_rows(table: DataFrame, billing: DataFrame) -> DataFrame:
    """Rows of a billing table (header, items or partners) for those numbers."""
    return pick(table, billing, ["vbeln"])


def condition_texts(texts: DataFrame, language: str | None = None) -> DataFrame:
    """One text row per condition type, the smallest in column order."""
    rows = texts if language is None else texts.where(F.col("spras") == language)
    return first_per_key(rows, ["kschl"])


def pricing_lines(pricing: DataFrame, texts: DataFrame, billing: DataFrame | None = None) -> DataFrame:
    rows = pick(pricing, billing, ["knumv"])
    return look_up(rows, condition_texts(texts), [("kschl", "kschl")], {"vtext": "vtext"}, "inner")


def pricing_summary(pricing: DataFrame, texts: DataFrame, billing: DataFrame | None = None) -> DataFrame:
    """Value per pricing document, inactive flag and condition type with its text."""
    sums = (
        pick(pricing, billing, ["knumv"])
        .groupBy("knumv", "kinak", "kschl")
        .agg(F.sum("kwert").alias("kwert_sum"))
    )
    texted = look_up(sums, condition_texts(texts), [("kschl", "kschl")], {"vtext": "vtext"}, "inner")
    return texted.select("knumv", "kinak", "kschl", "vtext", "kwert_sum")


def pricing_order(pricing: DataFrame) -> DataFrame:
    """Pricing documents in order, their conditions by item."""
    return pricing.orderBy("knumv", F.col("kposn").asc_nulls_last())


def pricing_summary_order(summary: DataFrame) -> DataFrame:
    """Conditions of a pricing document by inactive flag, then by their sum, smallest first."""
    return summary.orderBy("knumv", F.col("kinak").asc_nulls_last(), F.col("kwert_sum").asc_nulls_last())


# --- parties ----------------------------------------------------------------


def _ids(frame: DataFrame, columns: Sequence[str], name: str) -> DataFrame | None:
    """(document, id) pairs from those of ``columns`` the frame has."""
    present = [c for c in columns if c in frame.columns]
    if not present:
        return None
    values = F.array_compact(F.array(*[F.nullif(F.col(c), F.lit("")) for c in present]))
    return frame.select(*DOC_KEY, F.explode(F.array_distinct(values)).alias(name))


def _id_union(parts: Sequence[DataFrame | None], name: str) -> DataFrame:
    union = None
    for part in parts:
        if part is not None:
            union = part if union is None else union.unionByName(part)
    return union.select(*DOC_KEY, name).distinct()


def with_document(billing_table: DataFrame, billing: DataFrame) -> DataFrame:
    """Billing rows with the document key they belong to."""
    return billing_table.join(billing.select(*DOC_KEY, "vbeln"), "vbeln")


def vendors(ledger: DataFrame, vendor_master: DataFrame) -> DataFrame:
    """Vendors of a document: vendor and tax partner ids of its ledger lines."""
    pairs = _ids(ledger, ["lifnr", "gst_part"], "lifnr")
    if pairs is None:
        columns = vendor_master.select(*[named(c) for c in vendor_master.columns])
        return ledger.select(*DOC_KEY).where(F.lit(False)).join(columns, F.lit(False), "left")
    ids = pairs.distinct()
    return ids.join(vendor_master, "lifnr").select(*DOC_KEY, *[named(c) for c in vendor_master.columns])


def customers(ledger: DataFrame, billing_header: DataFrame, customer_master: DataFrame) -> DataFrame:
    """Customers of a document: ledger customer, payer and sold-to party."""
    ids = _id_union(
        [_ids(ledger, ["kunnr"], "kunnr"), _ids(billing_header, ["kunrg", "kunag"], "kunnr")], "kunnr"
    )
    master = customer_master.select("kunnr", "name1", "stcd3", "land1")
    return ids.join(master, "kunnr").select(*DOC_KEY, "kunnr", "name1", "stcd3", "land1")


def own_tax_ids(
    ledger: DataFrame, billing_header: DataFrame, billing_items: DataFrame, plants: DataFrame, vendor_master: DataFrame
) -> DataFrame:
    """The company's own names and tax ids: branches and plants seen in a document."""
    ids = _id_union(
        [
            _ids(ledger, ["bupla"], "werks"),
            _ids(billing_header, ["bupla"], "werks"),
            _ids(billing_items, ["werks"], "werks"),
        ],
        "werks",
    )
    owners = plants.select("werks", "lifnr").join(vendor_master.select("lifnr", "name1", "stcd3"), "lifnr")
    return ids.join(owners, "werks").select(*DOC_KEY, "werks", "name1", "stcd3")


# --- dossier ----------------------------------------------------------------


def dossier(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    numbers: Sequence[str] = (),
    pads: Mapping[str, int] | None = None,
    skip: Sequence[str] = (),
    rows_per_page: int = 10_000,
) -> DataFrame:
    """Text of each document for a text diff, as (document, page, text).

    A row prints as its key, then one line per remaining field in name order.
    Pages hold up to ``rows_per_page`` rows, so no task gathers a whole large
    document; its text is the concatenation of its pages.
    """
    pads = pads or {}
    types = {f.name: f.dataType for f in df.schema}
    width = max(len(c.strip()) for c in df.columns if not c.startswith("__")) + 1
    label = F.concat_ws("-", *[F.coalesce(named(c).cast("string"), F.lit("None")) for c in key])

    lines = [label, F.lit("\n")]
    for c in sorted((c for c in df.columns if c not in key and c not in skip), key=str.strip):
        cell = stripped(F.coalesce(value_text(named(c), types[c]), F.lit("")))
        if c in numbers:
            cell = rounded_amount(cell)
        if c in pads:
            cell = rjust_key(cell, pads[c])
        lines += [F.lit(f"\n\t{c.strip().ljust(width)}: "), cell]
    lines.append(F.lit("\n\n"))

    blocks = with_ordinal(df, key, order_by, "__ordinal").select(
        label.alias("document"),
        (F.floor((F.col("__ordinal") - 1) / rows_per_page) + 1).alias("page"),
        F.struct("__ordinal", F.concat(*lines).alias("block")).alias("__b"),
    )
    ordered = F.array_sort(F.collect_list("__b"))
    return blocks.groupBy("document", "page").agg(
        F.array_join(F.transform(ordered, lambda b: b["block"]), "").alias("text")
    )
