"""Company names, identifier keys and currencies found in titles, file names and headers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of the vendor's titles and file names.
SYMBOL = r"([A-Z]{2,}:\d*[A-Z0-9]+)"
PARENTHESES = r"(\([^)]+\))"
KEYED_PARENTHESES = r"(?i)(\(.*?(?:KEY|ID|IDENTIFIER).*?\))"
FILE_PREFIX = "SPGlobal_"
LISTING = r"(NASDAQ|NYSE)([A-Z]+)([A-Z]{1,5})"
NUMERIC_IDS = {"MI KEY": r"MIKEY(\d+)", "SPCIQ KEY": r"SPCIQKEY(\d+)", "TCUID": r"TCUID(\d+)"}

# Words and characters that rule a cell out as a company name.
NOT_A_NAME_WORDS = [
    "summary", "overview", "sustainability", "climate", "environment",
    "social", "governance", "index", "question", "average",
]
NOT_A_NAME_CHARACTERS = "[:#@%|=]"
VENDOR_NAME = "S&P Global"

# Currency notations.
NOT_A_CURRENCY = "%|actual|forecast|count|total|max|min|expected|estimated|proportion"
CURRENCY_SYMBOLS = "[$€£¥₹₽₩₺₴₣₦₱₲₪₫₭₸₼₾]"
CURRENCY_FORMS = [
    r"[A-Z]{2,3}\s*[MB]?",
    "(SEK|SKR)[mM]",
    "[Mm](SEK|SKR|kr|Kr)",
    "M(SEK|SKR|kr|Kr|KR)",
    "(kr|Kr|KR)M",
    "SEKm|SEKt|MSEK|Mkr|MKR|TSEK",
    r"(EUR?|GBP)\s*[mM]",
    "[mM](EUR?|GBP)",
    "[kKtT](EUR?|GBP|USD)",
    "EURm|EURk|GBPm|GBPk|USDm|USDk",
]
DEFAULT_CURRENCY = "$M"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _with(parts: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Work out ``parts`` once per row and hand them to ``body``, which may use them repeatedly."""
    shared = F.struct(*[c.alias(n) for n, c in parts.items()])
    return F.get(F.transform(F.array(shared), body), F.lit(0))


def symbol(text: Column) -> Column:
    """First exchange:ticker in a text."""
    return F.when(text.contains(":"), _found(text, SYMBOL))


def _name_before(text: Column, mark: Column) -> Column:
    head = F.trim(F.split_part(text, mark, F.lit(1)))
    return _filled(F.trim(F.regexp_replace(head, r"[,.;:]$", "")))


def split_title(text: Column) -> Column:
    """Name and key of a title: the text before the ticker, the ticker and the last parentheses."""

    def split(p: Column) -> Column:
        whole, ticker, blocks = p["text"], p["ticker"], p["blocks"]
        last = F.try_element_at(blocks, F.lit(-1))
        from_end = F.position(F.reverse(last), F.reverse(whole))
        before_last = F.trim(F.substring(whole, F.lit(1), F.length(whole) - from_end - F.length(last) + 1))
        before_first = F.trim(F.substring_index(whole, "(", 1))
        plain_name = F.when(F.size(blocks) > 1, before_last).when(F.size(blocks) == 1, before_first)
        name = F.when(ticker.isNotNull(), _name_before(whole, ticker)).otherwise(_filled(plain_name))
        key = F.when(ticker.isNotNull(), F.concat_ws(" ", ticker, last)).otherwise(last)
        return F.struct(name.alias("name"), key.alias("key"))

    def parts(p: Column) -> Column:
        blocks = F.regexp_extract_all(p["text"], F.lit(PARENTHESES), F.lit(1))
        return _with({"text": p["text"], "ticker": symbol(p["text"]), "blocks": blocks}, split)

    return _with({"text": text}, lambda p: F.when(p["text"].isNotNull(), parts(p)))


def title_cell(cell: Column) -> Column:
    """The part of a cell that may hold a title, null for every other cell."""

    def title(p: Column) -> Column:
        text = p["text"]
        piped = F.when(text.contains(" | "), F.trim(F.substring_index(text, " | ", 1)))
        return F.when(F.length(text) >= 10, F.coalesce(piped, F.when(symbol(text).isNotNull(), text)))

    return _with({"text": F.trim(cell)}, title)


def _camel_words(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "(?<!^)(?=[A-Z])", " "))


def vendor_file_entity(file_name: Column) -> Column:
    """Name and key of ``<prefix>NameInCamelCase[.EXCHANGETICKER]_..._MIKEY1_...`` file names."""
    parts = F.split(file_name, "_")

    def entity(p: Column) -> Column:
        words = _camel_words(F.substring_index(p["second"], ".", 1))
        name = F.trim(F.regexp_replace(words, r"(?i)(inc\.|inc|corporation)$", ""))
        tail = F.when(p["second"].contains("."), F.get(F.split(p["second"], r"\."), F.lit(1))).otherwise(p["third"])
        listed = F.when(F.coalesce(tail, F.lit("")).rlike(LISTING), tail).when(p["file"].rlike(LISTING), p["file"])
        return _with({"name": name, "listed": listed, "ids": p["ids"]}, keyed)

    def keyed(p: Column) -> Column:
        venue = F.regexp_replace(_found(p["listed"], f"({LISTING})"), LISTING, "$1$2:$3")
        key = F.when(p["ids"] == "", venue).otherwise(F.concat(venue, F.lit(" ("), p["ids"], F.lit(")")))
        return F.struct(_filled(p["name"]).alias("name"), key.alias("key"))

    ids = F.concat_ws(
        "; ", *[F.concat(F.lit(f"{label}: "), _found(file_name, shape)) for label, shape in NUMERIC_IDS.items()]
    )
    known = {"file": file_name, "second": F.get(parts, F.lit(1)), "third": F.get(parts, F.lit(2)), "ids": ids}
    found = F.when(file_name.startswith(FILE_PREFIX), _with(known, entity))
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("key")))


def generic_file_entity(file_name: Column) -> Column:
    """Name and key of ``Report_Some_Name_EXCHANGE_TICKER``-like file names."""

    def entity(p: Column) -> Column:
        parts = p["parts"]
        n = F.size(parts)
        inner = F.when(n >= 3, F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))))
        stop = F.array_min(F.transform(inner, lambda x, i: F.when(x.rlike("NASDAQ|NYSE|[A-Z]{2,5}$"), i)))
        kept = F.slice(inner, F.lit(1), F.coalesce(stop, F.size(inner)))
        return _with({"parts": parts, "kept": kept}, named)

    def named(p: Column) -> Column:
        parts, kept = p["parts"], p["kept"]
        spaced = F.regexp_replace(F.array_join(kept, " "), "([A-Z])", " $1")
        name = F.trim(F.regexp_replace(spaced, r"\s+", " "))

        def ticker(part: Column) -> Column:
            following = F.get(parts, F.array_position(parts, part).cast("int"))
            beside = F.when(following.rlike("^[A-Z]{1,5}$"), following)
            return F.coalesce(beside, _found(part, "([A-Z]{2,5})$"))

        def key(part: Column) -> Column:
            return F.concat(F.regexp_extract(part, "(NYSE|NASDAQ)", 1), F.lit(":"), ticker(part))

        listed = F.filter(parts, lambda x: x.rlike("NYSE|NASDAQ"))
        keys = F.array_compact(F.transform(listed, key))
        some = F.size(kept) > 0
        return F.struct(
            F.when(some, _filled(name)).alias("name"), F.when(some, F.get(keys, F.lit(0))).alias("key")
        )

    return _with({"parts": F.split(file_name, "_")}, entity)


def keyed_cell(cell: Column) -> Column:
    """Key and the name before it from a cell with a ticker or with KEY/ID parentheses."""

    def entity(p: Column) -> Column:
        text, ticker, block = p["text"], p["ticker"], p["block"]
        name = F.when(ticker.isNotNull(), _name_before(text, ticker)).otherwise(
            _filled(F.trim(F.split_part(text, block, F.lit(1))))
        )
        found = F.coalesce(ticker, block)
        return F.when(found.isNotNull(), F.struct(found.alias("key"), name.alias("name")))

    def parts(p: Column) -> Column:
        text = p["text"]
        block = F.when(text.contains("("), _found(text, KEYED_PARENTHESES))
        return F.when(F.length(text) >= 10, _with({"text": text, "ticker": symbol(text), "block": block}, entity))

    return _with({"text": F.trim(cell)}, parts)


def looks_like_name(cell: Column) -> Column:
    """Title-like cell: 6 to 49 characters, capital first, a blank, no excluded sign or word."""
    text = F.trim(cell)
    return (
        F.length(text).between(6, 49)
        & text.contains(" ")
        & text.rlike(r"^\p{Lu}")
        & ~text.rlike(NOT_A_NAME_CHARACTERS)
        & ~text.startswith(VENDOR_NAME)
        & ~F.lower(text).rlike("|".join(NOT_A_NAME_WORDS))
    )


def sided_file_company(file_name: Column) -> Column:
    """Part before ``Customers``/``Suppliers``, else the first part after the vendor prefix."""
    stem = F.regexp_replace(file_name, r"(?<=[^.])\.[^.]*$", "")
    parts = F.split(stem, "_")
    at = F.array_min(
        F.transform(parts, lambda p, i: F.when(p.isin("Customers", "Suppliers") & (i > 0), i))
    )
    rest = F.substring(stem, len(FILE_PREFIX) + 1, 1 << 30)
    prefixed = F.when(stem.startswith(FILE_PREFIX), F.substring_index(rest, "_", 1))
    return F.coalesce(_filled(F.get(parts, at - 1)), prefixed, F.lit(""))


def file_side(file_name: Column) -> Column:
    """``customer``, ``supplier`` or null when the name carries neither marker."""
    return F.when(file_name.contains("_Customers_"), F.lit("customer")).when(
        file_name.contains("_Suppliers_"), F.lit("supplier")
    )


def currency(header: Column) -> Column:
    """Currency notation inside a header's first parentheses, null when there is none."""

    def accepted(p: Column) -> Column:
        inside = p["inside"]
        short = (F.length(inside) <= 5) & inside.rlike("[MBK]") & ~inside.rlike("[a-z]")
        forms = "^(" + "|".join(CURRENCY_FORMS) + ")$"
        good = inside.rlike(CURRENCY_SYMBOLS) | inside.rlike(forms) | short
        return F.when(good & ~F.lower(inside).rlike(NOT_A_CURRENCY), inside)

    return _with({"inside": _found(header, r"\((.*?)\)")}, accepted)
