"""Name, address and date expressions: Column -> Column, JVM-side."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a name or street key leaves out, and how credit unions are written.
LEGAL = "the|inc|incorporated|llc|ltd|corp|corporation|company|co|national association|na|branch|sarl|sas|sasu|eurl|sa|sci|snc|societe|ste|ets|etablissements"
CREDIT_UNION = "federal credit union|credit union|fcu"
STREET_SKIP = "bis|ter|n|s|e|w|ne|nw|se|sw|north|south|east|west|rue|avenue|av|boulevard|bd|place|pl|quai|impasse|allee|chemin|cours|passage|square|villa|cite|faubourg|fg|route|rte|de|du|des|la|le|les|l|d|saint|st"
LEGAL_ENDING = "inc|incorporated|corp|corporation|llc|lp|llp|ltd"
# Capitals that stay, and abbreviations that are written as words.
STAY_CAPITAL = "NE|NW|SE|SW|II|III|IV|VI|VII|USA|US|PO"
ABBREVIATIONS = "ST|RD|DR|LN|CT|PL|PLZ|HWY|PKY|TRL|SQ|FL|MR|MRS|JR|SR|LTD|STE|BLDG"
STREET_WORDS = "st|street|ave|avenue|rd|road|blvd|dr|drive|ln|lane|hwy|highway|pkwy|way|ct|court|pl|place|sq"
SPACE = r"[ \t\n\f\r]"


@cache
def accent_map() -> tuple[str, str]:
    """Letters of U+00C0-U+024F and U+1E00-U+1EFF that decompose, and their base letters."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in block]
    pairs = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """Base letters; text of ASCII alone, which is most, is not looked up letter by letter."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, *accent_map()))


def null_if_empty(c: Column) -> Column:
    """``c``, computed once, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def clean_name(c: Column) -> Column:
    """Lower case, no accents, no apostrophes, backticks or full stops, '&' as 'and', the rest single spaces."""
    c = F.translate(F.lower(strip_accents(c)), "'’`.", "")
    return F.trim(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def norm_name(c: Column) -> Column:
    """clean_name without trailing numbers, legal words and articles; all ways to write credit union become one."""
    clean = clean_name(c)
    short = F.regexp_replace(F.regexp_replace(clean, "( [0-9]+)+$", ""), rf"\b(?:{CREDIT_UNION})\b", "cu")
    short = F.trim(F.regexp_replace(short, rf"(?:(?:^| )(?:{LEGAL})(?![a-z0-9]))+", ""))
    return F.coalesce(null_if_empty(short), clean)


def house_number(c: Column) -> Column:
    return null_if_empty(F.regexp_extract(c, rf"^{SPACE}*#?{SPACE}*([0-9]+)", 1))


def zip5(c: Column) -> Column:
    return null_if_empty(F.regexp_extract(c, rf"([0-9]{{5}})(-[0-9]{{4}})?{SPACE}*$", 1))


def street_key(c: Column) -> Column:
    """The first distinctive word after the house number, compass words, street types and articles."""
    return null_if_empty(F.regexp_extract(F.lower(strip_accents(c)), rf"^{SPACE}*#?{SPACE}*[0-9]+[a-z]?{SPACE}+(?:(?:{STREET_SKIP})[. ']+)*([a-z0-9]+)", 1))


def title_case(c: Column) -> Column:
    """All-capitals text as a sign would show it; text with small letters stays."""
    mark = "\x01"
    words = F.split(F.regexp_replace(F.trim(c), r"([-&/.(])", rf"$1{mark} "), " ")
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000)))

    def word(w: Column) -> Column:
        size = F.length(F.replace(w, F.lit(mark), F.lit("")))
        stays = w.rlike(rf"^({STAY_CAPITAL})$") | w.rlike("^[0-9]+[A-Z]$")
        vowelless = size.between(2, 4) & w.rlike(rf"^[B-DF-HJ-NP-TV-XZ]+[-&/.]?{mark}?$")
        return F.when(stays, w).when(w.rlike(rf"^({ABBREVIATIONS})[-&/.]?{mark}?$"), capital(w)).when(vowelless, w).otherwise(capital(w))

    shown = F.replace(F.array_join(F.transform(words, word), " "), F.lit(f"{mark} "), F.lit(""))
    return F.when(c.isNull() | (c != F.upper(c)) | ~c.rlike("[A-Z]"), c).otherwise(shown)


def display_name(c: Column) -> Column:
    return title_case(F.trim(F.regexp_replace(c, rf"{SPACE}*(#{SPACE}*[0-9]+[A-Z]?|\bSTORE{SPACE}+#?[0-9]+){SPACE}*$", "")))


def address_street(c: Column) -> Column:
    return title_case(F.split_part(c, F.lit(", "), F.lit(1)))


def address_city(c: Column) -> Column:
    return null_if_empty(title_case(F.split_part(c, F.lit(", "), F.lit(2))))


def address_state(c: Column) -> Column:
    return null_if_empty(F.regexp_extract(c, ", ([A-Z]{2}) [0-9]{5}", 1))


def join_address(*parts: Column) -> Column:
    """The trimmed parts that are not empty, joined by ', '."""
    return F.concat_ws(", ", *[null_if_empty(F.trim(p)) for p in parts])


def street_city(c: Column, part: str) -> Column:
    """'street town, ST zip' without a separator, split after its last street word: part 'street', 'city', 'state' or 'zip'."""
    at = {"street": 1, "city": 2, "state": 3, "zip": 4}[part]
    return null_if_empty(F.trim(F.regexp_extract(c, rf"(?i)^(.*\b(?:{STREET_WORDS})\b\.?) +([a-z .]+), *([a-z]{{2}}) +([0-9]{{5}})", at)))


def parse_date(c: Column) -> Column:
    """m/d/Y, m-d-Y, d Month Y, Y-m-d, YYYYMM, a spreadsheet serial or epoch milliseconds; null for anything else."""
    c = F.trim(c)
    day = lambda fmt: F.to_date(F.try_to_timestamp(c, F.lit(fmt)))
    return (
        F.when(c.rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), day("M/d/yyyy"))
        .when(c.rlike("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), day("M-d-yyyy"))
        .when(c.rlike("^[0-9]{1,2} [A-Za-z]{3,9} [0-9]{4}$"), F.coalesce(day("d MMMM yyyy"), day("d MMM yyyy")))
        .when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), day("yyyy-MM-dd"))
        .when(c.rlike("^[0-9]{6}$"), F.to_date(F.try_to_timestamp(F.concat(c, F.lit("01")), F.lit("yyyyMMdd"))))
        .when(c.rlike("^[0-9]{5}$"), F.date_add(F.lit("1899-12-30").cast("date"), c.cast("int")))
        .when(c.rlike("^[0-9]{12,13}$"), F.to_date(F.timestamp_millis(c.cast("long"))))
    )


def full_date(c: Column) -> Column:
    """A date of full Y-M-D form that exists, else null; '2024' and '2024-05' are not dates."""
    return F.when(c.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), c.try_cast("date"))


def trade_name(name: Column, dba: Column | None = None, suffix: str | None = None) -> Column:
    """The public name: a DBA column, else what stands behind 'DBA' in the name, else the name (with a suffix added)."""
    behind = null_if_empty(F.trim(F.regexp_extract(name, r"(?i)\b(?:d/?b/?a|trading as)\b[ :.]*(.*)$", 1)))
    out = F.coalesce(behind, F.trim(name))
    out = out if dba is None else F.coalesce(null_if_empty(F.trim(dba)), out)
    return out if suffix is None else F.when(F.lower(out).endswith(suffix.lower()), out).otherwise(F.concat(out, F.lit(suffix)))


def surrogate_id(*parts: Column, sep: str = "|", size: int = 16) -> Column:
    """The first hex digits of the SHA-1 of the upper-cased parts."""
    return F.substring(F.sha1(F.upper(F.concat_ws(sep, *parts)).cast("binary")), 1, size)


def source_family(c: Column) -> Column:
    return F.split_part(c, F.lit("_"), F.lit(1))


def hours_fallback(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)
