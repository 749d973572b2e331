"""Fixed values.

Everything in this module has to equal the value used by the listing tool whose
results we reproduce; none of it is derived.  Keep the order of every list and
dict: several rules take the first entry that matches.
"""

# --- table layouts -----------------------------------------------------------

SEARCH_LOG_FIELDS = ["Produkt", "Preis", "Region", "Link"]

RAW_FIELDS = ["titel", "aktualitaet", "preis", "land", "versand", "link", "image"]

CLEAN_ORDER = [
    "title",
    "product_condition",
    "price",
    "currency",
    "product_origin",
    "shipping_cost",
    "price_with_shipping",
    "product_name",
]

# shown name -> clean column
DISPLAY_FIELDS = {
    "produkt": "title",
    "preis": "price",
    "region": "product_origin",
    "link": "link",
    "image": "image",
    "aktualitaet": "product_condition",
    "versand": "shipping_cost",
    "währung": "currency",
}

# --- header synonyms, first hit wins -------------------------------------------

TITLE_HEADERS = ["Titel", "title", "Title"]
CONDITION_HEADERS = [
    "Zustand",
    "zustand",
    "Condition",
    "condition",
    "aktualitaet",
    "Aktualitaet",
]
PRICE_HEADERS = ["Preis", "preis", "Price", "price"]
COUNTRY_HEADERS = ["Land", "land", "Country", "country", "Herkunft", "herkunft"]
SHIPPING_HEADERS = [
    "Versandkosten",
    "versandkosten",
    "Versand",
    "versand",
    "Shipping",
    "shipping",
]
PICTURE_LINK_HEADERS = ["link zum bild", "link_zum_bild"]

# --- text rules ------------------------------------------------------------------

NOT_GIVEN = "keine Angabe"
DEFAULT_ORIGIN = "aus Schweiz"

TITLE_BAD_PHRASES = [
    "wird in neuem fenster oder tab geöffnet",
    "wird in neuem fenster geöffnet",
    "wird in einem neuen fenster oder tab geöffnet",
    "öffnet sich in einem neuen fenster oder tab",
    "opens in a new window or tab",
    "open in a new window or tab",
]
TITLE_TAIL_CHARS = " -:–—•"

AD_TITLE_SUBSTRINGS = [
    "shop on ebay",
    "shoppen auf ebay",
    "gesponsert",
    "sponsored",
    "anzeige",
    "advertisement",
    "ad:",
]

ITEM_PATH = "/itm/"

# Damaged spellings of "Großbritannien" (two hold the invisible control U+009F).
GREAT_BRITAIN_SPELLINGS = [
    "GroÃŸbritannien",
    "GroÃ\u009fbritannien",
    "GroÃ£Â\u009fbritannien",
    "GroÃYbritannien",
    "Großbritannien",
]
GREAT_BRITAIN = "Grossbritannien"

# --- money rules -------------------------------------------------------------------

CURRENCY_KEYS = {
    "€": "EUR",
    "eur": "EUR",
    "euro": "EUR",
    "chf": "CHF",
    "sfr": "CHF",
    "fr.": "CHF",
    "fr": "CHF",
    "$": "USD",
    "usd": "USD",
    "£": "GBP",
    "gbp": "GBP",
}

# Words that stand around an amount; tried in this order at each position.
AMOUNT_NOISE = r"versand|inkl\.?|exkl\.?|inklusive|zzgl\.?|\+"

# Cell texts that count as missing when a raw listing file is read
# (the default missing-value words of pandas' CSV reader).
MISSING_WORDS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# --- search ------------------------------------------------------------------------

SEARCH_URL = (
    "https://www.ebay.ch/sch/i.html"
    "?_nkw={}&_sacat=0&_from=R40&_trksid=m570.l1313&_udhi={}"
)
MAX_PAGES = 4
MAX_QUERY_WORDS = 5

# --- page markup -------------------------------------------------------------------

CARD_SELECTOR = "li.s-card, div.s-card, li.s-item, div.s-item"
TITLE_SELECTOR = (
    ".s-card__title .su-styled-text.primary.default, "
    ".s-card__title [class*='su-styled-text'], "
    "[role='heading'].s-card__title, "
    ".s-item__title"
)
PRICE_SELECTOR = (
    ".s-card__attribute-row .s-card__price, "
    ".su-card-container__attributes__primary .s-card__price, "
    ".su-styled-text.primary.italic.large-1.s-card__price, "
    ".s-item__price"
)
ATTRIBUTE_SELECTOR = (
    ".s-card__attribute-row .su-styled-text.secondary.italic.large, "
    ".s-card__attribute-row .su-styled-text.secondary.large, "
    ".s-item__location, "
    ".s-item__itemLocation"
)
CONDITION_SELECTOR = (
    ".s-card__subtitle-row .su-styled-text.secondary.default, "
    ".s-card__subtitle .su-styled-text.secondary.default, "
    ".SECONDARY_INFO, "
    ".s-item__subtitle .SECONDARY_INFO"
)
LINK_SELECTOR = "a.s-item__link, a[role='link'][href*='/itm/'], a[href*='/itm/']"
IMAGE_SELECTOR = "img.s-card__image, img.s-item__image-img, img.s-item__image"
NEXT_SELECTOR = ".pagination__next, a[rel='next'], a[aria-label='Weiter']"

# Image sources after "src", in the order they are tried; "srcset" comes last.
IMAGE_FALLBACK_ATTRIBUTES = ["data-src", "data-img", "data-srcset", "data-lazy"]
