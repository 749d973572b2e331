"""DuckDB SQL for the registered queries, written from the rules, not the code."""

from __future__ import annotations

from checks.feeds import (
    LISTING_ORDER,
    chf_price,
    in_duckdb,
    listings_sql,
    long_links_sql,
    own_link,
    page_links_sql,
    shared_link,
)

ORDER = ", ".join(LISTING_ORDER)
MARKET = "https://www.ebay.ch/sch/i.html?_nkw="


def _listings(bad_rows: bool = False) -> str:
    return f"l AS ({in_duckdb(listings_sql(bad_rows))})"


def _currency(column: str) -> str:
    low = f"lower({column})"
    return f"""CASE
      WHEN contains({low}, '€') OR contains({low}, 'eur') THEN 'EUR'
      WHEN contains({low}, 'chf') OR contains({low}, 'sfr') OR contains({low}, 'fr')
        THEN 'CHF'
      WHEN contains({low}, '$') OR contains({low}, 'usd') THEN 'USD'
      WHEN contains({low}, '£') OR contains({low}, 'gbp') THEN 'GBP' END"""


def _kept_characters(column: str) -> str:
    return f"""trim(regexp_replace(regexp_replace({column},
      '(?i)(versand|inkl\\.?|exkl\\.?|inklusive|zzgl\\.?|\\+)', ' ', 'g'),
      '[^0-9.,\\s]', '', 'g'))"""


def _plain_number(s: str) -> str:
    parts = f"string_split({s}, ',')"
    return f"""replace(CASE
      WHEN contains({s}, '.') AND contains({s}, ',')
        THEN replace(replace({s}, '.', ''), ',', '.')
      WHEN contains({s}, ',') AND length({parts}[-1]) <= 3
        THEN array_to_string({parts}[1:-2], '') || '.' || {parts}[-1]
      ELSE replace({s}, ',', '') END, ' ', '')"""


def _number(s: str) -> str:
    return f"""CASE WHEN regexp_full_match({s}, '[0-9]+\\.?[0-9]*|\\.[0-9]+')
      THEN TRY_CAST({s} AS DOUBLE) END"""


def _title(column: str) -> str:
    t = f"trim({column})"
    return f"""CASE
      WHEN contains(lower({t}), 'wird in neuem fenster oder tab geöffnet')
        THEN trim(rtrim(left({t},
          instr(lower({t}), 'wird in neuem fenster oder tab geöffnet') - 1), ' -:–—•'))
      WHEN contains(lower({t}), 'wird in neuem fenster geöffnet')
        THEN trim(rtrim(left({t},
          instr(lower({t}), 'wird in neuem fenster geöffnet') - 1), ' -:–—•'))
      WHEN contains(lower({t}), 'opens in a new window or tab')
        THEN trim(rtrim(left({t},
          instr(lower({t}), 'opens in a new window or tab') - 1), ' -:–—•'))
      ELSE {t} END"""


def _condition(column: str) -> str:
    return f"""CASE WHEN {column} IS NULL THEN 'keine Angabe' ELSE
      coalesce(nullif(trim(regexp_replace({column}, '\\s*\\|\\s*$', '')), ''),
        'keine Angabe') END"""


def _origin(column: str) -> str:
    t = f"trim(regexp_replace(coalesce({column}, ''), '(?i)^\\s*aus\\s+', ''))"
    return f"""CASE WHEN {t} IN ('GroÃYbritannien', 'Großbritannien')
      THEN 'Grossbritannien' ELSE {t} END"""


def _product_name_ctes(source: str) -> str:
    """CTEs that add ``name`` to a source with ``link``; the last one is ``named``."""
    return f"""
    query AS (SELECT *, regexp_extract(link, '^[^#?]*\\?([^#]*)', 1) AS q FROM {source}),
    parameter AS (SELECT *, coalesce(
        nullif(regexp_extract(q, '(^|&)(s|%73)kw=([^&]+)', 3), ''),
        nullif(regexp_extract(q, '(^|&)_skw=([^&]+)', 2), '')) AS raw FROM query),
    decoded AS (SELECT *, trim(url_decode(url_decode(replace(raw, '+', ' ')))) AS d
        FROM parameter),
    named AS (SELECT *, nullif(upper(left(d, 1)) || substr(d, 2), '') AS name
        FROM decoded)"""


def _derived_ctes(bad_rows: bool, source: str | None = None) -> str:
    """CTEs up to ``derived``: all clean columns for good and bad rows."""
    return f"""
    {source or _listings(bad_rows)},
    {_product_name_ctes('l')},
    kept AS (SELECT *, {_kept_characters('preis')} AS p1,
        {_kept_characters('versand')} AS v1 FROM named),
    plain AS (SELECT *, {_plain_number('p1')} AS p2, {_plain_number('v1')} AS v2 FROM kept),
    numbers AS (SELECT *, {_number('p2')} AS price,
        coalesce({_number('v2')}, 0.0) AS shipping_cost FROM plain),
    derived AS (SELECT * EXCLUDE (q, raw, d, name, p1, v1, p2, v2),
        CASE WHEN titel IN ('', 'NA') THEN NULL ELSE titel END AS title,
        {_condition("nullif(aktualitaet, 'NA')")} AS product_condition,
        coalesce({_currency('preis')}, {_currency('versand')}, 'keine Angabe') AS currency,
        {_origin('land')} AS product_origin,
        price + shipping_cost AS price_with_shipping,
        name AS product_name
        FROM numbers)"""


def _clean_ctes(bad_rows: bool) -> str:
    """CTEs up to ``clean``: good rows, first of each duplicate."""
    return f"""{_derived_ctes(bad_rows)},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY title, price, link
        ORDER BY {ORDER}) AS nth FROM derived
        WHERE price IS NOT NULL AND product_name IS NOT NULL),
    clean AS (SELECT * EXCLUDE (nth) FROM ranked WHERE nth = 1)"""


CLEAN = """title, product_condition, price, currency, product_origin, shipping_cost,
    price_with_shipping, product_name, link, image"""

SHOWN = """trim(coalesce(title, '')) AS produkt, CAST(price AS VARCHAR) AS preis,
    product_origin AS region, link, image, product_condition AS aktualitaet,
    CAST(shipping_cost AS VARCHAR) AS versand, currency AS "währung" """

SHOWN_PLUS = f"""{SHOWN}, {ORDER},
    CAST(price AS VARCHAR) || ' ' || currency AS preis_text, price AS sort_key"""


def _scalar(name: str, expression: str) -> str:
    return f"WITH {_listings(True)} SELECT {ORDER}, {expression} AS {name} FROM l"


def _number_query(name: str, expression: str) -> str:
    return f"WITH {_derived_ctes(True)} SELECT {ORDER}, {expression} AS {name} FROM derived"


MENU_CARDS = """
    SELECT page_id, url, CAST(n - 1 AS INTEGER) AS pos, titles[n] AS title_text,
      hrefs[n] AS href
    FROM (SELECT page_id, url,
            regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
            regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS titles
          FROM pages), LATERAL (SELECT unnest(range(1, len(hrefs) + 1)) AS n)"""

LINKS = in_duckdb(page_links_sql())

# The six cards of each result page, as they have to come out.
RESULT_CARDS = f"""
    SELECT search_id, page_id, o_custkey, o_orderkey, 0 AS pos,
      'Ski & Schuh ' || o_orderstatus || ' ' || o_custkey AS title_text,
      {chf_price()} AS price_text, 'Gebraucht |' AS condition_text,
      '+CHF 3.47 Versand | aus Deutschland' AS attr_texts, {shared_link()} AS href,
      NULL AS img_data_src, 'https://img.example/' || o_orderkey || '.webp' AS image,
      'aus Deutschland' AS land, '+CHF 3.47 Versand' AS versand FROM links
    UNION ALL SELECT search_id, page_id, o_custkey, o_orderkey, 1, 'Shop on eBay', '', '',
      '', {own_link()}, NULL, '', 'aus Schweiz', '' FROM links
    UNION ALL SELECT search_id, page_id, o_custkey, o_orderkey, 2,
      o_orderpriority || ' ' || o_custkey || ' – wird in neuem Fenster oder Tab geöffnet',
      'EUR 1.234,50', 'Brandneu', 'from China', {own_link()}, 'a.jpg 1x, b.jpg 2x', 'a.jpg',
      'aus Schweiz', '' FROM links
    UNION ALL SELECT search_id, page_id, o_custkey, o_orderkey, 3, '', '', '', '',
      {own_link()} || 'x', NULL, '', 'aus Schweiz', '' FROM links
    UNION ALL SELECT search_id, page_id, o_custkey, o_orderkey, 4, 'Hilfe', '', '', '',
      'https://shop.example/help', NULL, '', 'aus Schweiz', '' FROM links
    UNION ALL SELECT search_id, page_id, o_custkey, o_orderkey, 5, 'Nochmals', 'USD 7', '',
      '', {shared_link()}, NULL, '', 'aus Schweiz', '' FROM links"""

OFFERS = f"""links AS ({LINKS}), cards AS ({RESULT_CARDS}),
    offers AS (SELECT *, replace(title_text, ' – wird in neuem Fenster oder Tab geöffnet', '')
        AS titel FROM cards WHERE pos IN (0, 2, 5))"""

WALK = f"""walk AS (
      SELECT search_id, 1 AS page_no, url, page_id, next_href FROM links
      WHERE url LIKE 'https://www.ebay.ch/%'
      UNION ALL
      SELECT w.search_id, w.page_no + 1, p.url, p.page_id, p.next_href
      FROM walk w JOIN links p ON p.search_id = w.search_id AND p.url = w.next_href
      WHERE w.page_no < 4)"""


def _raw_rows(page_no: str, source: str) -> str:
    """Offers of the source pages, first of each link within a search."""
    return f"""SELECT search_id, page_no, pos, titel, condition_text AS aktualitaet,
      price_text AS preis, land, versand, href AS link, image
      FROM (SELECT o.*, {page_no} AS page_no, row_number() OVER (
              PARTITION BY o.search_id, href ORDER BY {page_no}, pos) AS nth
            FROM {source}) AS numbered WHERE nth = 1"""


ALL_PAGES = _raw_rows("CAST(o.page_id % 6 + 1 AS BIGINT)", "offers o")
WALKED = _raw_rows("w.page_no", "walk w JOIN offers o ON o.page_id = w.page_id")


def _attr_choices() -> str:
    return """list_filter([versand,
        CASE WHEN l_linenumber = 2 THEN '+Aufschlag aus Lager' END,
        CASE WHEN l_orderkey % 3 = 0 THEN 'from China' WHEN l_orderkey % 3 = 1 THEN land END,
        CASE WHEN l_orderkey % 5 = 0 THEN 'Australien' END], lambda t: t IS NOT NULL)"""


def _position(sort: str) -> str:
    return f"""WITH {_clean_ctes(True)} SELECT {ORDER}, CAST(price AS VARCHAR) AS preis,
      price AS sort_key,
      row_number() OVER (ORDER BY {sort}, {ORDER}) AS position FROM clean"""


# What is left of raw listings in Latin-1.
PLAIN_RAW = f"""WITH {_listings()} SELECT translate(titel, '€–•', 'E-*') AS titel,
    aktualitaet, translate(preis, '€–•', 'E-*') AS preis, land, versand, link, image
    FROM l"""


ORACLES = {
    "page_cards": MENU_CARDS,
    "seen_links": f"""SELECT page_id, pos, href AS link, title_text AS titel FROM (
        SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS nth
        FROM ({MENU_CARDS}) AS c) AS r WHERE nth = 1""",
    "result_cards": f"""WITH links AS ({LINKS}) SELECT search_id, page_id, pos, title_text,
        price_text, condition_text, attr_texts, href, img_data_src
        FROM ({RESULT_CARDS}) AS cards""",
    "raw_listings": f"WITH {OFFERS} {ALL_PAGES}",
    "scrape_stats": f"""WITH {OFFERS}, kept AS (
            SELECT search_id, page_no, count(*) AS n FROM ({ALL_PAGES}) AS r GROUP BY ALL),
        card_counts AS (SELECT search_id, page_id, count(*) AS n
            FROM (WITH links AS ({LINKS}) SELECT * FROM ({RESULT_CARDS}) AS r) GROUP BY ALL)
        SELECT l.search_id, l.page_id, coalesce(c.n, 0) AS cards_found,
            coalesce(kept.n, 0) AS usable_offers
        FROM ({LINKS}) AS l LEFT JOIN card_counts AS c USING (search_id, page_id)
        LEFT JOIN kept ON kept.search_id = l.search_id AND kept.page_no = l.page_id % 6 + 1""",
    "offers_found": f"""WITH {OFFERS} SELECT s.search_id, count(r.search_id) AS offers_found
        FROM (SELECT DISTINCT search_id FROM ({LINKS}) AS l) AS s
        LEFT JOIN ({ALL_PAGES}) AS r ON r.search_id = s.search_id GROUP BY s.search_id""",
    "long_amounts": r"""WITH t AS (SELECT doc_id, translate(regexp_replace(text,
            '[^\x20\x09-\x0D]+', '1', 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12)
            || chr(13), '......') AS d FROM documents)
        SELECT doc_id, try_cast(replace(d, '.', '') || '.5' AS DOUBLE) AS grouped,
            CASE WHEN regexp_full_match(d, '[0-9]+\.?[0-9]*|\.[0-9]+') THEN try_cast(d AS DOUBLE) END AS dots,
            CASE WHEN d NOT LIKE '%.%' THEN try_cast(d AS DOUBLE)
                 WHEN length(d) - length(rtrim(d, '1')) <= 3 THEN
                   try_cast(replace(left(d, length(rtrim(d, '1')) - 1), '.', '') || '.'
                     || right(d, length(d) - length(rtrim(d, '1'))) AS DOUBLE) END AS commas,
            CASE WHEN d NOT LIKE '%.%' THEN try_cast(d || '1.25' AS DOUBLE) END AS mixed
        FROM t""",
    "page_walk": f"""WITH RECURSIVE links AS ({LINKS}), {WALK}
        SELECT search_id, page_no, url, page_id FROM walk""",
    "seen_across_runs": f"WITH {OFFERS} {ALL_PAGES}",
    "long_walk": f"""WITH RECURSIVE links AS ({in_duckdb(long_links_sql())}), walk AS (
          SELECT search_id, 1::BIGINT AS page_no, url, page_id, next_href FROM links WHERE url = search_id || '/0'
          UNION ALL
          SELECT w.search_id, w.page_no + 1, p.url, p.page_id, p.next_href
          FROM walk w JOIN links p ON p.search_id = w.search_id AND p.url = w.next_href
          WHERE w.page_no < 250)
        SELECT search_id, min(page_no) AS page_no, url, page_id FROM walk GROUP BY search_id, url, page_id""",
    "run_search": f"""WITH RECURSIVE {OFFERS}, {WALK},
        {_derived_ctes(False, source=f"l AS ({WALKED})")},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY search_id, title, price, link
            ORDER BY page_no, pos) AS nth FROM derived)
        SELECT search_id, page_no, pos, {CLEAN} FROM ranked WHERE nth = 1""",
    "clean_title": _scalar("title", _title("titel")),
    "ad_filter": f"""WITH {_listings()} SELECT {ORDER}, titel FROM l
        WHERE NOT regexp_matches(titel,
        '(?i)shop on ebay|shoppen auf ebay|gesponsert|sponsored|anzeige|advertisement|ad:')""",
    "clean_condition": _scalar("product_condition", _condition("aktualitaet")),
    "clean_origin": _scalar("product_origin", _origin("land")),
    "extract_currency": _scalar("currency", _currency("preis")),
    "parse_number_eu": _number_query("price", "price"),
    "currency_fallback": _number_query("currency", "currency"),
    "price_with_shipping": _number_query("price_with_shipping", "price_with_shipping"),
    "skw_product_name": f"""WITH {_listings(True)}, {_product_name_ctes('l')}
        SELECT {ORDER}, name AS product_name FROM named""",
    "ship_origin_split": f"""WITH {_listings()}, a AS (SELECT {ORDER}, {_attr_choices()} AS t
            FROM l),
        b AS (SELECT *,
            list_filter(t, lambda x: contains(lower(x), 'versand') OR x LIKE '+%') AS ships,
            list_filter(t, lambda x: NOT contains(lower(x), 'versand')) AS others FROM a),
        c AS (SELECT *, coalesce(list_filter(others, lambda x: x NOT LIKE '+%' AND
            (contains(lower(x), 'aus ') OR contains(lower(x), 'from ')))[1],
            others[-1]) AS found FROM b)
        SELECT {ORDER}, coalesce(ships[1], '') AS versand,
          CASE WHEN contains(lower(found), 'aus') THEN found ELSE 'aus Schweiz' END AS land
        FROM c""",
    "image_url": f"""WITH {_listings()} SELECT {ORDER}, CASE l_linenumber
        WHEN 2 THEN '' WHEN 4 THEN image || '?a,b' ELSE image END AS image_url FROM l""",
    "search_url": f"""SELECT doc_id, '{MARKET}' || replace(url_encode(array_to_string(
          list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')[1:5], ' ')),
          '%20', '+') || '&_sacat=0&_from=R40&_trksid=m570.l1313&_udhi=' || n_chars
          AS search_url FROM documents""",
    "chf_format": """SELECT o_orderkey,
        'CHF ' || replace(format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT)), ',',
          chr(39)) AS price,
        'CHF ' || regexp_extract(o_orderpriority, '[0-9]+') AS priority,
        o_orderstatus AS status FROM orders""",
    "resolve_columns": f"""WITH {_listings()} SELECT titel, '' AS aktualitaet, preis, land,
        versand, 'old' AS "Price", link, image AS link_bild, {ORDER} FROM l""",
    "first_url_column": f"""WITH {_listings()} SELECT {ORDER}, 'link' AS url_column, link AS url
        FROM l""",
    "url_columns": f"""WITH {_listings()} SELECT
        bool_or(regexp_matches(titel, 'https?://')) AS titel,
        bool_or(regexp_matches(aktualitaet, 'https?://')) AS aktualitaet,
        bool_or(regexp_matches(preis, 'https?://')) AS preis,
        bool_or(regexp_matches(land, 'https?://')) AS land,
        bool_or(regexp_matches(versand, 'https?://')) AS versand,
        bool_or(regexp_matches(link, 'https?://')) AS link,
        bool_or(regexp_matches(image, 'https?://')) AS image FROM l""",
    "clean_listings": f"WITH {_clean_ctes(False)} SELECT {CLEAN}, {ORDER} FROM clean",
    "clean_renamed_headers": f"""WITH {_clean_ctes(False)} SELECT title, price, currency,
        product_origin, shipping_cost, price_with_shipping, product_name,
        'old' AS "Price_2", link, image AS link_bild, {ORDER} FROM clean""",
    "clean_good_rows": f"WITH {_clean_ctes(True)} SELECT {CLEAN}, {ORDER} FROM clean",
    "rejected_rows": f"""WITH {_derived_ctes(True)} SELECT {ORDER}, CASE
        WHEN product_name IS NULL THEN 'product_name' ELSE 'price' END AS missing_field
        FROM derived WHERE product_name IS NULL OR price IS NULL""",
    "quality_report": f"""WITH {_clean_ctes(True)} SELECT count(*) AS rows_read,
        count(*) FILTER (WHERE product_name IS NULL) AS missing_product_name,
        count(*) FILTER (WHERE price IS NULL) AS missing_price,
        count(*) FILTER (WHERE product_name IS NOT NULL AND price IS NOT NULL)
          - (SELECT count(*) FROM clean) AS duplicates_removed FROM derived""",
    "dedupe_listings": f"""WITH {_listings()} SELECT {ORDER}, titel, preis, link FROM (
        SELECT *, row_number() OVER (PARTITION BY titel, preis, link ORDER BY {ORDER}) AS nth
        FROM l) AS r WHERE nth = 1""",
    "duplicate_count": f"""WITH {_listings()} SELECT count(*) - (SELECT count(*) FROM
        (SELECT DISTINCT titel, preis, link FROM l) AS d) AS duplicates_removed FROM l""",
    "max_price_filter": f"""WITH {_clean_ctes(True)} SELECT {ORDER}, title, price FROM clean
        WHERE price <= 950""",
    "keyword_filter": f"""WITH {_clean_ctes(True)} SELECT {ORDER}, title FROM clean
        WHERE contains(lower(title), 'red') AND contains(lower(title), 'widget')""",
    "keyword_search": f"""WITH {_listings()}, worded AS (SELECT {ORDER},
            regexp_extract_all(lower(titel), '[\\p{{L}}\\p{{N}}]+') AS words FROM l),
        queries AS (SELECT DISTINCT p_name AS query_id, ['neuem', split_part(p_name, ' ', 1),
              split_part(p_name, ' ', 2)] AS asked FROM part
            UNION SELECT DISTINCT p_name || '*', [left(p_name, 2), split_part(p_name, ' ', 1),
              split_part(p_name, ' ', 2)] FROM part)
        SELECT query_id, {ORDER} FROM worded JOIN queries ON list_has_all(words, asked)""",
    "result_rows": f"WITH {_clean_ctes(True)} SELECT {SHOWN_PLUS} FROM clean",
    "filter_land": f"""WITH {_clean_ctes(True)} SELECT {SHOWN_PLUS} FROM clean
        WHERE product_origin = 'Grossbritannien'""",
    "sort_price_asc": _position("price"),
    "sort_price_desc": _position("price DESC"),
    "land_options": f"""WITH {_clean_ctes(True)} SELECT region,
        row_number() OVER (ORDER BY region COLLATE de, region) AS position FROM (
        SELECT DISTINCT product_origin AS region FROM clean WHERE product_origin <> '')""",
    "result_view": f"""WITH {_clean_ctes(True)} SELECT {SHOWN_PLUS} FROM clean
        WHERE product_origin = 'Österreich'""",
    "search_log": """SELECT regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS "Produkt", CAST(n_chars AS VARCHAR) AS "Preis",
        CASE WHEN doc_id % 2 = 0 THEN coalesce(lang, '') ELSE '' END AS "Region",
        '' AS "Link" FROM documents""",
    "raw_csv_scan": f"""WITH {_listings()} SELECT ' "neu",' || chr(10) || titel AS titel,
        aktualitaet, preis, land, versand, link, image FROM l""",
    "raw_csv_one_file": f"""WITH {_listings()} SELECT ' "neu",' || chr(10) || titel AS titel,
        aktualitaet, preis, land, versand, link, image FROM l""",
    "raw_csv_varied": f"""WITH {_listings()} SELECT
          CASE WHEN l_orderkey % 3 < 2 THEN titel END AS titel,
          CASE WHEN l_orderkey % 3 <> 1 THEN aktualitaet END AS aktualitaet, preis, land,
          CASE WHEN l_orderkey % 3 < 2 THEN versand END AS versand,
          CASE WHEN l_orderkey % 3 < 2 THEN link END AS link,
          CASE WHEN l_orderkey % 3 <> 1 THEN image END AS image,
          CASE WHEN l_orderkey % 3 = 2 THEN l_orderkey || '-' || l_linenumber END AS "Posten"
        FROM l""",
    "raw_csv_types": f"""WITH {_listings()}, t AS (SELECT unnest([
            {{'p': 0, 'c': 'titel', 'v': titel}}, {{'p': 1, 'c': 'aktualitaet', 'v': aktualitaet}},
            {{'p': 2, 'c': 'preis', 'v': preis}}, {{'p': 3, 'c': 'land', 'v': land}},
            {{'p': 4, 'c': 'versand', 'v': versand}}, {{'p': 5, 'c': 'link', 'v': link}},
            {{'p': 6, 'c': 'image', 'v': image}}, {{'p': 7, 'c': 'l_orderkey', 'v': l_orderkey::VARCHAR}},
            {{'p': 8, 'c': 'l_extendedprice', 'v': l_extendedprice::VARCHAR}},
            {{'p': 9, 'c': 'gaps', 'v': CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey::VARCHAR END}},
            {{'p': 10, 'c': 'flag', 'v': (l_orderkey % 2 = 0)::VARCHAR}},
            {{'p': 11, 'c': 'mostly', 'v': CASE WHEN l_orderkey = 7 THEN 'n. v.' ELSE l_orderkey::VARCHAR END}},
            {{'p': 12, 'c': 'nothing', 'v': NULL}}]) AS u FROM l),
        v AS (SELECT u.p AS place, u.c AS "column", CASE WHEN u.v <> 'NA' THEN u.v END AS v FROM t)
        SELECT place, "column", bool_or(v IS NULL) AS missing, CASE
            WHEN count(v) = 0 THEN 'void'
            WHEN bool_and(v IN ('true', 'false')) THEN 'boolean'
            WHEN bool_and(regexp_full_match(v, '[0-9]+')) THEN CASE WHEN bool_or(v IS NULL) THEN 'double' ELSE 'bigint' END
            WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'double'
            ELSE 'string' END AS type
        FROM v GROUP BY v.place, "column" """,
    "raw_csv_latin1": PLAIN_RAW,
    "raw_csv_mixed": PLAIN_RAW,
    "raw_roundtrip": f"WITH {_clean_ctes(False)} SELECT {SHOWN} FROM clean",
    "clean_roundtrip": f"""WITH {_clean_ctes(True)} SELECT title, product_condition,
        CAST(price AS VARCHAR) AS price, currency, nullif(product_origin, '') AS product_origin,
        CAST(shipping_cost AS VARCHAR) AS shipping_cost,
        CAST(price_with_shipping AS VARCHAR) AS price_with_shipping, product_name, link, image
        FROM clean""",
}
ORACLES["saved_search"] = ORACLES["run_search"]
ORACLES["captured_cards"] = ORACLES["page_cards"]

# A third of the searches has the rows of a second run, the others those of the first.
PUBLISHED = f"""WITH {_derived_ctes(False)},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey % 12, title, price, link
        ORDER BY {ORDER}) AS nth FROM derived
        WHERE l_suppkey % 4 <> 0 OR l_linenumber <= 3)
    SELECT {CLEAN}, {ORDER}, 's' || (l_suppkey % 12) AS search_id FROM ranked WHERE nth = 1"""
ORACLES["published_searches"] = PUBLISHED
ORACLES["published_cheap"] = f"{PUBLISHED} AND product_origin = 'Österreich' AND price <= 1000"
