"""Listings and result pages derived from the given tables.

The tables hold no listings, so these SELECTs build some, row by row, in SQL that
reads alike in Spark and DuckDB.  ``{lineitem}`` and the like stand for tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Unique together, so they tell which listing comes first.
LISTING_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
]


def _whole(number: str, by: int) -> str:
    return f"CAST(floor({number} / {by}) AS BIGINT)"


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _padded(number: str, width: int) -> str:
    return f"lpad({_text(number)}, {width}, '0')"


def listings_sql(bad_rows: bool) -> str:
    """Raw listings, one per line item, with every style of text a rule speaks of.

    ``bad_rows`` turns part of them into rows without a price or product name.
    """
    cents = "CAST(round(p.p_retailprice * 100) AS BIGINT)"
    units, rest = _whole("cents", 100), _padded("cents % 100", 2)
    thousands = (
        f"CASE WHEN cents >= 100000 THEN {_text(_whole('cents', 100000))} || '.' || "
        f"{_padded(f'({units} % 1000)', 3)} ELSE {_text(units)} END"
    )
    bad_price = "WHEN l_orderkey % 23 = 0 THEN 'Preis auf Anfrage' " if bad_rows else ""
    bad_price += "WHEN l_orderkey % 23 = 1 THEN 'Fr. 12.50' " if bad_rows else ""
    bad_link = "WHEN l_orderkey % 19 = 0 THEN '?hash=1' " if bad_rows else ""
    plus = "replace(p_name, ' ', '+')"
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      CASE
        WHEN l_orderkey % 11 = 0 THEN 'Anzeige ' || p_name
        WHEN l_orderkey % 13 = 0 THEN 'NA'
        WHEN l_orderkey % 7 = 0
          THEN p_name || ' – wird in neuem Fenster oder Tab geöffnet'
        WHEN l_orderkey % 7 = 1
          THEN '  ' || p_name || ' • - Opens in a NEW window or tab (wird in neuem Fenster geöffnet)'
        WHEN l_orderkey % 7 = 2 THEN 'iPad: ' || p_name
        ELSE p_name END AS titel,
      CASE l_linenumber
        WHEN 3 THEN NULL WHEN 4 THEN 'NA' WHEN 5 THEN ' | '
        WHEN 6 THEN p_type || ' | |' ELSE p_type || ' |' END AS aktualitaet,
      CASE {bad_price}
        WHEN p_partkey % 9 = 0 THEN 'CHF ' || {_text(units)} || '.' || {rest}
        WHEN p_partkey % 9 = 1 THEN 'EUR ' || {thousands} || ',' || {rest}
        WHEN p_partkey % 9 = 2 THEN {_text(units)} || ',5 €'
        WHEN p_partkey % 9 = 3 THEN 'USD ' || {_text(units)}
        WHEN p_partkey % 9 = 4 THEN '£' || {_text(units)}
        WHEN p_partkey % 9 = 5 THEN {_text(units)} || '.' || {rest}
        WHEN p_partkey % 9 = 6
          THEN 'SFR 1' || chr(39) || {_padded(f'({units} % 1000)', 3)} || '.' || {rest}
        WHEN p_partkey % 9 = 7
          THEN 'CHF ' || {_text(units)} || ',50 bis CHF ' || {_text(units)} || ',99'
        ELSE 'inkl. Versand ' || {_text(units)} || ',1234 EUR' END AS preis,
      CASE n_nationkey
        WHEN 0 THEN ' AUS  GroÃYbritannien' WHEN 1 THEN 'aus Großbritannien'
        WHEN 2 THEN 'aus Österreich' WHEN 3 THEN 'aus Ägypten' WHEN 4 THEN 'Zypern'
        WHEN 5 THEN NULL WHEN 6 THEN 'aus oman' WHEN 7 THEN 'aus Oman'
        ELSE 'aus ' || n_name END AS land,
      CASE l_linenumber
        WHEN 1 THEN '+CHF 3.47 Versand' WHEN 2 THEN 'Gratis'
        WHEN 3 THEN '+ EUR 12,00 Versand' WHEN 4 THEN NULL
        WHEN 5 THEN 'Versandkostenfrei' WHEN 6 THEN '+USD 7 Versand'
        ELSE 'Kostenloser Versand' END AS versand,
      'https://shop.example/itm/' || {_text('p_partkey')} || CASE {bad_link}
        WHEN p_partkey % 6 = 0 THEN '?_skw=' || {plus}
        WHEN p_partkey % 6 = 1
          THEN '?hash=1&skw=' || replace(p_name, ' ', '%20') || '&_skw=other#skw=end'
        WHEN p_partkey % 6 = 2 THEN '?_skw=' || replace(p_name, ' ', '%2520') || '%252B'
        WHEN p_partkey % 6 = 3 THEN '?_skw=&_skw=' || {plus} || '&_skw=later'
        WHEN p_partkey % 6 = 4 THEN '?%73kw=' || {plus} || '&skw=later'
        ELSE '?_skw=%C3%BCber+100%+' || {plus} END AS link,
      'https://img.example/' || {_text('p_partkey')} || '.jpg' AS image
    FROM (
      SELECT l.*, p.*, n.*, {cents} AS cents
      FROM {{lineitem}} l
      JOIN {{part}} p ON l.l_partkey = p.p_partkey
      JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
      JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey
    ) AS joined
    """


# One page per order; six pages make a search.
def _page_url(page: str) -> str:
    block, place = _text(_whole(page, 6)), f"{page} % 6"
    return (
        f"CASE WHEN {place} = 0 THEN 'https://www.ebay.ch/sch/i.html?_nkw=ski+schuhe+'"
        f" || {block} || '&_sacat=0&_from=R40&_trksid=m570.l1313&_udhi=999'"
        f" ELSE 'https://shop.example/sch?s=' || {block} || '&p=' || {_text(place)} END"
    )


def page_links_sql() -> str:
    """Pages of searches: ids, address, and the address of the next page.

    Some searches end early, some link back to their start, and some have a next
    link without an address.
    """
    block, place = _whole("o_orderkey", 6), "o_orderkey % 6"
    return f"""
    SELECT *, 's' || {_text(block)} AS search_id, o_orderkey AS page_id,
      {_page_url('o_orderkey')} AS url,
      CASE
        WHEN {place} = 5 THEN NULL
        WHEN {block} % 4 = 1 AND {place} = 1 THEN NULL
        WHEN {block} % 4 = 3 AND {place} = 0 THEN NULL
        WHEN {block} % 4 = 2 AND {place} = 2 THEN {_page_url('(o_orderkey - 2)')}
        ELSE {_page_url('(o_orderkey + 1)')} END AS next_href
    FROM {{orders}}
    """


def long_links_sql() -> str:
    """Searches of 200 pages: one in three ends after 70 pages or less, one leads back
    from its last page to an earlier one."""
    block, place = _whole("o_orderkey", 200), "o_orderkey % 200"
    search = f"'w' || {_text(block)}"
    ahead = f"{search} || '/' || {_text(f'({place} + 1)')}"
    return f"""
    SELECT {search} AS search_id, o_orderkey AS page_id,
      {search} || '/' || {_text(place)} AS url,
      CASE WHEN {block} % 3 = 1 AND {place} >= {block} % 70 THEN ''
        WHEN {place} = 199 AND {block} % 3 = 2 THEN {search} || '/' || {_text(f'({block} % 150)')}
        ELSE {ahead} END AS next_href
    FROM {{orders}}
    """


def shared_link(block: str = "search_id") -> str:
    """Item link that several pages of one search hold."""
    return (
        f"'https://shop.example/itm/' || {block} || {_text('o_custkey % 3')}"
        f" || '?hash=1&_skw=ski+' || {_text('o_custkey % 3')}"
    )


def own_link() -> str:
    """Item link that only this page holds."""
    return f"'https://shop.example/itm/' || {_text('o_orderkey')} || '?_skw=schuh'"


def chf_price() -> str:
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    return (
        f"'CHF ' || {_text(_whole(cents, 100))} || '.' || {_padded(cents + ' % 100', 2)}"
    )


def result_pages_sql() -> str:
    """Result pages with six cards each: three offers, of them one repeated link,
    an advertisement, a card without title, and one that links to no item."""

    def in_html(text: str) -> str:
        return f"replace({text}, '&', '&amp;')"

    offer = f"""
      '<li class="s-card s-card--horizontal"><a class="pic" href="' || {in_html(shared_link())}
      || '"><img class="s-card__image" src="https://img.example/' || {_text('o_orderkey')}
      || '.webp"></a><div class="s-card__title"><span class="su-styled-text primary default">'
      || 'Ski &amp; Schuh <b>' || o_orderstatus || '</b> ' || {_text('o_custkey')}
      || '</span><span class="clipped">Wird in neuem Fenster geöffnet</span></div>'
      || '<div class="s-card__subtitle-row"><span class="su-styled-text secondary default">'
      || 'Gebraucht |</span></div><div class="s-card__attribute-row">'
      || '<span class="su-styled-text primary bold large-1 s-card__price">' || {chf_price()}
      || '</span></div><div class="s-card__attribute-row">'
      || '<span class="su-styled-text secondary large">+CHF 3.47 Versand</span></div>'
      || '<div class="s-card__attribute-row"><span class="su-styled-text secondary large">'
      || 'aus Deutschland</span></div></li>'"""
    advert = f"""
      '<li class="s-item"><a class="s-item__link" href="' || {own_link()} || '">'
      || '<h3 class="s-item__title">Shop on eBay</h3></a></li>'"""
    legacy = f"""
      '<li class="s-item"><a class="s-item__link" href=" ' || {own_link()} || ' ">'
      || '<h3 class="s-item__title">' || o_orderpriority || ' ' || {_text('o_custkey')}
      || ' – wird in neuem Fenster oder Tab geöffnet</h3></a><!-- x --><br>'
      || '<div class="s-item__subtitle"><span class="SECONDARY_INFO">Brandneu</span></div>'
      || '<span class="s-item__price">EUR <s>1.234,50</s></span>'
      || '<span class="s-item__location">from China</span>'
      || '<img class="s-item__image" src="" data-src="a.jpg 1x, b.jpg 2x"></li>'"""
    untitled = f"""
      '<div class="s-card"><a role="link" href="' || {own_link()} || 'x">go</a></div>'"""
    elsewhere = """
      '<div class="s-item"><a class="s-item__link" href="https://shop.example/help">'
      || '<h3 class="s-item__title">Hilfe</h3></a></div>'"""
    repeated = f"""
      '<li class="s-item"><a class="s-item__link" href="' || {in_html(shared_link())}
      || '"><h3 class="s-item__title">Nochmals</h3></a>'
      || '<span class="s-item__price">USD 7</span></li>'"""
    return f"""
    SELECT search_id, page_id, url,
      '<!DOCTYPE html><html><head><style>p</style></head><body><ul class="srp-results">'
      || {offer} || {advert} || {legacy} || {untitled} || {elsewhere} || {repeated}
      || '</ul><nav>' || CASE
        WHEN next_href IS NOT NULL THEN '<a class="pagination__next" href="'
          || {in_html('next_href')} || '">Weiter</a>'
        WHEN o_orderkey % 2 = 0 THEN '<a class="pagination__next">Weiter</a>'
        ELSE '' END || '</nav></body></html>' AS html
    FROM ({page_links_sql()}) AS links
    """


#: Rows of a given table that one task derives from, at most (nearly, as rows are dealt).
ROWS_A_TASK = 250_000


def _dealt(table: DataFrame) -> DataFrame:
    """The given tables lie in few splits; deriving from them takes all cores, and more
    tasks, not larger ones, if there are more rows."""
    tasks = max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // ROWS_A_TASK))
    return table.repartition(tasks)


#: Tables with a row for each derived one; the others are only looked up in.
DEALT = ("lineitem", "orders")


def _table(spark: SparkSession, sf_dir: str, name: str, deal: bool = True) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _dealt(table) if deal and name in DEALT else table


def run_in_spark(spark: SparkSession, sf_dir: str, sql: str, deal: bool = True) -> DataFrame:
    tables = {
        name: _table(spark, sf_dir, name, deal)
        for name in ("lineitem", "part", "supplier", "nation", "orders")
        if "{" + name + "}" in sql
    }
    return spark.sql(sql, **tables)


def in_duckdb(sql: str) -> str:
    for name in ("lineitem", "part", "supplier", "nation", "orders"):
        sql = sql.replace("{" + name + "}", name)
    return sql


def listings(spark: SparkSession, sf_dir: str, bad_rows: bool = False) -> DataFrame:
    return run_in_spark(spark, sf_dir, listings_sql(bad_rows))


def ordered_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listings`` sorted by ``LISTING_ORDER``.

    The joined rows are sorted, and the texts made of them after that, so the one shuffle
    holds no texts; it deals the rows to tasks, too.
    """
    inner = ") AS joined"
    assert listings_sql(False).count(inner) == 1
    sql = listings_sql(False).replace(inner, f"ORDER BY {', '.join(LISTING_ORDER)}{inner}")
    return run_in_spark(spark, sf_dir, sql, deal=False)


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_spark(spark, sf_dir, result_pages_sql())
