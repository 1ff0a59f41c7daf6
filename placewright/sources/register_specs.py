"""Specifications of public registers as data: which of a register's own columns are what, and which rows count.

``Layout`` names columns; ``spec`` turns one into the expressions of a ``RegisterSpec``, ``evidence_of`` applies all that
were landed. A register that has both open and closed rows has a condition for the closed ones. Rows that tie for the newest
or the first of a key go by the columns in ``order``, then by name and address."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.registers import RegisterSpec, normalize_many
from .scan import FileSpec


@dataclass(frozen=True)
class Layout:
    """Columns are given by name; what is called a condition or an expression is SQL over them.

    ``name`` is the first of its columns that is not empty, ``street`` all of its columns, ``id`` all, joined by hyphens.
    ``state`` is an expression. ``day`` is a column with the row's own date or an expression in brackets, without it the
    register's date counts. ``newest`` keeps a key's newest row by ``day``, ``once`` one row of the values of its columns
    (upper case). ``expires`` is a column of dates; rows without a readable one are kept or not by ``undated``. ``years``
    keeps rows no older than that. ``signs`` replaces legal names by those on the building."""

    id: tuple[str, ...]
    name: tuple[str, ...]
    street: tuple[str, ...]
    city: str
    state: str
    zip: str
    lat: str | None = None
    lng: str | None = None
    day: str | None = None
    keep: str | None = None
    closed: str | None = None
    closed_source: str | None = None
    newest: tuple[str, ...] = ()
    once: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    expires: str | None = None
    undated: str = "keep"
    years: int | None = None
    derive: tuple[tuple[str, str], ...] = ()
    signs: tuple[tuple[str, str], ...] = ()
    upper_city: bool = False
    file: FileSpec | None = None


# Column names, codes and words of the registers themselves.
STOREFRONT_TRADES = ("44", "45", "71", "72", "81")
RETAIL_LICENSES = ("20", "21", "40", "41", "42", "47", "48", "61", "23", "75", "02", "74", "51", "52", "57")
BANK_SIGNS = (
    ("JPMorgan Chase Bank, National Association", "Chase Bank"),
    ("Manufacturers and Traders Trust Company", "M&T Bank"),
    ("The Huntington National Bank", "Huntington Bank"),
    ("Branch Banking and Trust Company", "BB&T"),
)


def _any(column: str, values: tuple[str, ...]) -> str:
    return f"`{column}` in ({', '.join(repr(v) for v in values)})"


REGISTERS: dict[str, Layout] = {
    "able_ok": Layout(
        id=("License #",), name=("DBA NAME",), street=("FULL ADDRESS",), city="CITY", state="'OK'", zip="ZIP",
        keep="`STATE` = 'OK'", expires="DATE EXPIRATION", once=("DBA NAME", "FULL ADDRESS"), order=("License #",),
        derive=(("DATE EXPIRATION", "regexp_replace(substring(`DATE EXPIRATION`, 1, 10), '[.][0-9]*$', '')"),),
        file=FileSpec(skip_until="DBA NAME")),
    "abc_ca": Layout(
        id=("File Number",), name=("DBA Name", "Primary Name"), street=("Prem Addr 1",), city="Prem City", state="`Prem State`", zip="Prem Zip",
        keep=f"`Lic or App` = 'LIC' and `Type Status` = 'ACTIVE' and {_any('License Type', RETAIL_LICENSES)}", once=("File Number",), order=("License Type",),
        day="(regexp_replace(regexp_extract(`_preamble`, '[0-9]{1,2}[a-z]* of [A-Za-z]+ [0-9]{4}', 0), '^([0-9]+)[a-z]* of ', '$1 '))",
        file=FileSpec(encoding="utf-8-sig", skip_until="License Type")),
    "cdph_chicago": Layout(
        id=("license_",), name=("aka_name", "dba_name"), street=("address",), city="'CHICAGO'", state="'IL'", zip="zip", lat="latitude", lng="longitude", day="inspection_date",
        keep="results in ('Pass', 'Pass w/ Conditions', 'Fail', 'Out of Business') and license_ <> '0'", closed="results = 'Out of Business'", closed_source="cdph_chicago_oob",
        newest=("license_",), order=("inspection_id",), years=5),
    "cpa_tx": Layout(
        id=("tp_number", "loc_number"), name=("loc_name",), street=("address_number", "address_text"), city="loc_city", state="'TX'", zip="loc_zip",
        keep=f"loc_state = 'TX' and out_of_business_date is null and {_any('sector', STOREFRONT_TRADES)} and not startswith(naics, '454')", derive=(("sector", "substring(naics, 1, 2)"),)),
    "dbpr_fl_food": Layout(
        id=("license",), name=("name",), street=("street",), city="city", state="'FL'", zip="zip", day="date", keep="length(trim(date)) = 10", newest=("license",), upper_city=True,
        file=FileSpec(encoding="iso-8859-1", columns=["district", "county_code", "county", "kind", "license", "name", "street", "city", "zip", "inspection", "visit", "class", "type", "disposition", "date"])),
    "dmv_ny": Layout(
        id=("facility",), name=("sign",), street=("facility_street",), city="facility_city", state="'NY'", zip="facility_zip_code", lat="lat", lng="lng",
        keep="facility_state = 'NY'", expires="expiration_date", undated="drop", once=("facility",), order=("expiration_date",),
        derive=(("sign", "concat_ws(' ', facility_name, facility_name_overflow)"), ("lng", "georeference.coordinates[0]"), ("lat", "georeference.coordinates[1]"))),
    "dohmh_nyc": Layout(
        id=("camis",), name=("dba",), street=("building", "street"), city="boro", state="'NY'", zip="zipcode", lat="latitude", lng="longitude", day="inspection_date",
        keep="substring(inspection_date, 1, 10) > '2000-01-01'", newest=("camis", "dba", "building", "street", "boro", "zipcode", "latitude", "longitude"), upper_city=True),
    "dpor_va": Layout(
        id=("list", "CERTIFICATE #"), name=("BUSINESS NAME",), street=("FIRST LINE ADDRESS",), city="CITY", state="'VA'", zip="FIVE DIGIT ZIP CODE",
        keep="trim(`STATE`) = 'VA'", expires="EXPIRATION DATE", once=("BUSINESS NAME", "FIRST LINE ADDRESS"), order=("list", "CERTIFICATE #"),
        derive=(("list", "regexp_extract(`_file`, '([0-9]+)__crnt', 1)"),),
        file=FileSpec(sep="\t", quote="", encoding="cp1252", skip_until="CERTIFICATE #")),
    "fdic_history": Layout(
        id=("UNINUM",), name=("INSTNAME",), street=("OFF_PADDR",), city="OFF_PCITY", state="OFF_PSTALP", zip="OFF_PZIP5", lat="OFF_LATITUDE", lng="OFF_LONGITUDE", day="EFFDATE",
        keep="CHANGECODE = 721 and coalesce(OFF_SERVTYPE, 0) <> 13 and OFF_LATITUDE <> 0 and OFF_LONGITUDE <> 0", closed="true", closed_source="fdic_history", signs=BANK_SIGNS),
    "fdic_locations": Layout(
        id=("UNINUM",), name=("NAME",), street=("ADDRESS",), city="CITY", state="STALP", zip="ZIP", lat="LATITUDE", lng="LONGITUDE", day="RUNDATE",
        keep="coalesce(SERVTYPE, 0) <> 13", signs=BANK_SIGNS),
    "nces_schools": Layout(
        id=("id",), name=("name",), street=("street",), city="city", state="state", zip="zip", lat="lat", lng="lng", keep="id rlike '^[0-9]{2}'",
        file=FileSpec(sep="|", quote="", header=False, columns=["id", "agency", "name", "year", "street", "city", "state", "zip", "state_code", "county_code", "county", "locale", "lat", "lng"])),
    "tdlr_tx": Layout(
        id=("license_number",), name=("business_name",), street=("business_address_line1",), city="town", state="'TX'", zip="town_zip",
        keep="license_type like '%Establishment%' and town_zip <> ''", expires="license_expiration_date_mmddccyy", undated="drop",
        derive=(("town", r"regexp_extract(business_city_state_zip, '^(.*?)\\s+TX\\s+([0-9]{5})', 1)"), ("town_zip", r"regexp_extract(business_city_state_zip, '^(.*?)\\s+TX\\s+([0-9]{5})', 2)"))),
}


def _column(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _filled(c: Column) -> Column:
    return text.null_if_empty(F.trim(c))


def _day(of: str) -> Column:
    c = F.expr(of) if of.startswith("(") else _column(of)
    return text.parse_date(F.regexp_replace(F.trim(c), "^([0-9]{4}-[0-9]{2}-[0-9]{2})[T ].*$", "$1"))


def spec(source: str, layout: Layout, today: date, as_of: date | None = None) -> RegisterSpec:
    """The layout's expressions. ``as_of`` is the register's own date, for layouts without a ``day`` (default: today).

    Positions of zero are none. Null and missing values of name, street, city and zip are left out."""
    name = F.coalesce(*[_filled(_column(c)) for c in layout.name])
    sign = name
    for legal, shown in layout.signs:
        sign = F.when(name == legal, shown).otherwise(sign)
    city = F.expr(layout.city) if layout.city.startswith("'") else _column(layout.city)
    tail = F.concat_ws(" ", _filled(F.expr(layout.state)), _filled(F.substring(F.trim(_column(layout.zip)), 1, 5)))
    address = text.join_address(F.concat_ws(" ", *[_filled(_column(c)) for c in layout.street]), F.upper(city) if layout.upper_city else city, tail)
    place = [F.nullif(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)) if c else None for c in (layout.lat, layout.lng)]
    day = _day(layout.day) if layout.day else None
    keep = F.expr(layout.keep) if layout.keep else F.lit(True)
    if layout.years:
        keep = keep & (day > F.lit(today - timedelta(days=365 * layout.years)))
    gone = F.expr(layout.closed) if layout.closed else F.lit(False)

    def prepare(raw: DataFrame) -> DataFrame:
        df = raw.withColumns({c: F.expr(e) for c, e in layout.derive}) if layout.derive else raw
        return df.withColumns({"_sign": sign, "_address": address, **({"_day": day} if day is not None else {})})

    return RegisterSpec(
        source=F.when(gone, layout.closed_source).otherwise(source) if layout.closed else source,
        id=F.concat_ws("-", *[F.trim(_column(c)) for c in layout.id]), name=F.col("_sign"), address=F.col("_address"),
        state=F.when(gone, "closed").otherwise("open"), day=F.col("_day") if day is not None else None, as_of=as_of,
        lat=place[0], lng=place[1], keep=keep, expires=layout.expires and f"`{layout.expires}`", undated=layout.undated,
        newest_by=[f"`{c}`" for c in layout.newest], newest_day="_day" if layout.newest else None,
        dedupe=[F.upper(F.trim(_column(c))) for c in layout.once],
        order=[*[f"`{c}`" for c in layout.order], "_sign", "_address"], prepare=prepare)


def evidence_of(raws: dict[str, DataFrame], today: date, as_of: dict[str, date] | None = None) -> DataFrame:
    """Evidence of all registers landed as {source: rows}; a source that has no layout is an error."""
    dates = as_of or {}
    return normalize_many(raws, {s: spec(s, REGISTERS[s], today, dates.get(s)) for s in raws}, today)
