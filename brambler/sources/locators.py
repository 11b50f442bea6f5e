"""Locator payloads: one mapping for each brand, from JSON to rows of organisations.

A mapping names the fields of an entry, where a payload's entries are and which expressions fill the columns; one schema
with just these fields parses a payload in one go. register() adds a mapping; unknown brands give no rows. All of it is
built-in expressions.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import shared_path

COLUMNS = ["name", "address", "suburb", "state", "postcode", "phone", "website_url", "api_email"]
# States by name.
STATES = {
    "new south wales": "NSW", "victoria": "VIC", "queensland": "QLD", "south australia": "SA", "western australia": "WA",
    "tasmania": "TAS", "northern territory": "NT", "australian capital territory": "ACT",
}


def text(path: str) -> Column:
    """A trimmed field, null if empty."""
    return F.nullif(F.trim(F.col(path).cast("string")), F.lit(""))


def either(*paths: str) -> Column:
    """The first field that isn't empty, trimmed; null if it is blank."""
    return F.nullif(F.trim(F.coalesce(*[F.nullif(F.col(p).cast("string"), F.lit("")) for p in paths])), F.lit(""))


def lowered(path: str) -> Column:
    return F.lower(text(path))


def first_nonempty(array: str, name: str, containing: str | None = None) -> Column:
    """The first non-empty field over an array of structs."""
    values = F.transform(F.col(array), lambda x: F.trim(x[name]))
    ok = lambda v: F.coalesce(F.contains(v, F.lit(containing)) if containing else v != "", F.lit(False))
    return F.get(F.filter(values, ok), F.lit(0))


def state_of(name: Column, fallback: bool = True) -> Column:
    table = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    found = F.try_element_at(table, F.lower(F.trim(name)))
    return F.coalesce(found, name) if fallback else found


def state_in(whole: Column) -> Column:
    """The first abbreviation that a text contains."""
    return F.coalesce(*[F.when(F.contains(whole, F.lit(s)), F.lit(s)) for s in ("NSW", "VIC", "QLD", "SA", "WA", "TAS", "NT", "ACT")])


def postcode_in(whole: Column) -> Column:
    return F.nullif(F.regexp_extract(whole, r"\b(\d{4})\b", 1), F.lit(""))


def phone_in(whole: Column) -> Column:
    return F.nullif(F.regexp_extract(whole, r"(\(?0\d\)?[ \d]{8,12}|1[38]00[ \d]{6,8})", 1), F.lit(""))


def address_by_commas(whole: Column) -> dict[str, Column]:
    """street, suburb, state, postcode of 'street, suburb, STATE 3000' and its shorter forms."""
    parts = F.transform(F.split(whole, ","), lambda x: F.trim(x))
    n, get = F.size(parts), lambda i: F.get(parts, F.lit(i))
    tail = F.when(n >= 4, F.concat_ws(" ", F.slice(parts, 3, F.greatest(n - 2, F.lit(1))))).when(n == 3, get(2))
    return {"address": F.when(n >= 3, get(0)).otherwise(whole), "suburb": F.when(n >= 3, get(1)), "state": state_in(tail), "postcode": postcode_in(tail)}


def address_by_regex(whole: Column) -> dict[str, Column]:
    """Street by its type, then suburb, state and postcode; without a known street type the first part is the street."""
    strict = r"^(.*?\b(?:Street|St|Road|Rd|Highway|Hwy|Avenue|Ave|Drive|Dr|Parade|Pde|Way|Court|Ct|Boulevard|Blvd|Lane)\b\.?),?\s+(.*?),?\s+([A-Z]{2,3})\s+(\d{4})"
    loose = r"^([^,]+),\s*(.*?),?\s+([A-Z]{2,3})\s+(\d{4})"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(whole, strict, i), F.lit("")), F.nullif(F.regexp_extract(whole, loose, i), F.lit("")))
    return {"address": F.coalesce(part(1), whole), "suburb": part(2), "state": part(3), "postcode": part(4)}


@dataclass
class Mapping:
    #: Fields of an entry that are read: dotted paths, `[]` behind a field that is a list.
    paths: list[str]
    columns: dict[str, Callable[[], Column]]
    #: Dotted path of the list of entries; empty: the payload is that list.
    entries: str = ""
    #: The payload is a map by state of objects that hold the entries at this path, each with a code.
    by_state: bool = False
    keep: Callable[[], Column] | None = None
    #: Path of the field by which the first of several entries counts.
    once: str | None = None


BRANDS: dict[str, Mapping] = {}


def register(brand: str, mapping: Mapping) -> None:
    BRANDS[brand] = mapping


def schema_of(paths: list[str]) -> str:
    """DDL of a struct with these paths; all leaves are strings (of other values their JSON)."""
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.split("."):
            at = at.setdefault(step, {})
    one = lambda name, sub: f"`{name.removesuffix('[]')}`:" + ("array<%s>" if name.endswith("[]") else "%s") % (f"struct<{','.join(one(k, v) for k, v in sub.items())}>" if sub else "string")
    return f"struct<{','.join(one(k, v) for k, v in tree.items())}>"


def entries_of(raw: DataFrame, m: Mapping) -> DataFrame:
    """seq, pos, e (an entry) and _state (its key in a map by state) of each payload."""
    listed = f"array<{schema_of(m.paths)}>"
    for step in reversed(m.entries.split(".") if m.entries else []):
        listed = f"struct<`{step}`:{listed}>"
    if m.by_state:
        rows = raw.select("seq", F.explode(F.from_json("payload_json", f"map<string,struct<code:string,{listed.removeprefix('struct<')}>")).alias("_state", "p"))
        return rows.filter(m.keep()).select("seq", "_state", F.posexplode(f"p.{m.entries}").alias("pos", "e"))
    whole = F.trim("payload_json")
    if m.entries:  # an object, or a list of such objects
        whole = F.when(whole.startswith("["), whole).otherwise(F.concat(F.lit("["), whole, F.lit("]")))
        parsed = F.from_json(whole, f"array<{listed}>")
        lists = F.transform(parsed, lambda x: functools.reduce(lambda at, step: at[step], m.entries.split("."), x))
        return raw.select("seq", F.lit(None).cast("string").alias("_state"), F.posexplode(F.flatten(F.filter(lists, lambda x: x.isNotNull()))).alias("pos", "e"))
    rows = raw.select("seq", F.from_json(whole, listed).alias("p"))
    return rows.select("seq", F.lit(None).cast("string").alias("_state"), F.posexplode("p").alias("pos", "e"))


def project(raw: DataFrame, brand: str, limit: int | None = None) -> DataFrame:
    """Organisations of a brand from locator_raw(brand_slug, seq, payload_json); rows without a name go."""
    m = BRANDS.get(brand)
    rows = raw.filter(F.col("brand_slug") == brand)
    if m is None:
        return rows.limit(0).select(F.lit(brand).alias("brand_slug"), "seq", *[F.lit(None).cast("string").alias(c) for c in COLUMNS])
    rows = entries_of(rows, m)
    if m.keep and not m.by_state:
        rows = rows.filter(m.keep())
    if m.once:
        rows = rows.withColumn("code", text(m.once)).filter("code is not null")
        first = Window.partitionBy("code").orderBy("seq", "pos")
        rows = rows.withColumn("n", F.row_number().over(first)).filter("n = 1")
    out = rows.select(F.lit(brand).alias("brand_slug"), "seq", *[(m.columns[c]() if c in m.columns else F.lit(None)).cast("string").alias(c) for c in COLUMNS]).filter("name is not null")
    return out.orderBy("seq").limit(limit) if limit else out


def project_all(raw: DataFrame) -> DataFrame:
    """Organisations of all brands. The payloads are read once and laid down by brand, so each mapping reads its own only."""
    path = shared_path(raw.sparkSession, "locator-payloads")
    raw.select("brand_slug", "seq", "payload_json").withColumn("brand", F.col("brand_slug")).write.partitionBy("brand").parquet(path)
    laid = raw.sparkSession.read.schema(f"brand_slug string, seq {dict(raw.dtypes)['seq']}, payload_json string, brand string").parquet(path)
    return functools.reduce(DataFrame.unionByName, [project(laid.filter(F.col("brand") == b).drop("brand"), b) for b in BRANDS])


def true_of(path: str) -> Column:
    return F.coalesce(F.lower(F.col(path)) == "true", F.lit(False))


def _simple(entries: str = "", once: str | None = None, lower: str | None = None, more: dict | None = None, keep: Callable[[], Column] | None = None, paths: tuple = (), **fields: str) -> Mapping:
    """A mapping of columns that are one field each; lower: the field of the email; more: other expressions."""
    columns: dict[str, Callable[[], Column]] = {c: (lambda p=p: text(f"e.{p}")) for c, p in fields.items()}
    if lower:
        columns["api_email"] = lambda: lowered(f"e.{lower}")
    named = [*fields.values(), *([lower] if lower else []), *([once] if once else []), *paths]
    return Mapping(list(dict.fromkeys(named)), columns | (more or {}), entries, keep=keep, once=f"e.{once}" if once else None)


# Names of fields in the payloads of each brand.
register("toyota", _simple("results", "dealerCode", "email", name="name", address="address", suburb="city", state="state", postcode="postCode", phone="telephone", website_url="webSite"))
register("mitsubishi", _simple("data.stockists.locations", "identifier", name="name", address="address.street", suburb="address.city", state="address.region", postcode="address.postcode", phone="address.phone", website_url="website"))
register("hyundai", _simple(lower="email", name="tradingName", address="streetName", suburb="suburb", state="state", postcode="postcode", phone="phone", paths=("webAddress", "url"), more={"website_url": lambda: either("e.webAddress", "e.url")}))
register("kia", _simple("dataInfo", name="dealerNm", suburb="addr", state="area", phone="phone", website_url="homepage", paths=("addrSC", "email"), more={
    "address": lambda: either("e.addrSC", "e.addr"), "postcode": lambda: postcode_in(either("e.addrSC", "e.addr")),
    "api_email": lambda: F.trim(F.split_part(lowered("e.email"), F.lit(","), F.lit(1)))}))
# cards of a map search: only what their text shows, no address and no site
_CARD = {"state": lambda: state_in(F.col("e.text")), "postcode": lambda: postcode_in(F.col("e.text")), "phone": lambda: F.nullif(F.regexp_extract("e.text", r"\(?\d{2}\)?\s?\d{4}\s?\d{4}", 0), F.lit(""))}
for _brand in ("ford", "audi", "volvo"):
    register(_brand, _simple(once="name", name="name", paths=("text",), more=_CARD, keep=lambda b=_brand: F.contains(F.lower("e.name"), F.lit(b))))
register("mazda", _simple(name="name", address="address", suburb="suburb", state="state", postcode="postCode", website_url="website", paths=("departments[].phone", "departments[].email"), more={
    "phone": lambda: F.get(F.filter(F.transform("e.departments", lambda x: x["phone"]), lambda v: F.coalesce(v != "", F.lit(False))), F.lit(0)),
    "api_email": lambda: F.nullif(F.lower(F.trim(F.get(F.filter(F.transform("e.departments", lambda x: x["email"]), lambda v: F.coalesce(v != "", F.lit(False))), F.lit(0)))), F.lit(""))}))
register("nissan", _simple("dealers", name="name", address="address.addressLine1", suburb="address.city", state="address.stateCode", postcode="address.postalCode", paths=("contact.websites[].url", "contact.phones[].value", "departments[].contact.email"), more={
    "website_url": lambda: F.get("e.contact.websites", F.lit(0))["url"], "phone": lambda: F.get("e.contact.phones", F.lit(0))["value"],
    "api_email": lambda: F.get(F.filter(F.transform("e.departments", lambda x: F.lower(F.trim(x["contact"]["email"]))), lambda v: F.coalesce(F.contains(v, F.lit("@")), F.lit(False))), F.lit(0))}))
_DEPARTMENTS = ("Sales", "Service", "Parts")


def _active(value: Callable[[str], Column]) -> Column:
    """The first value that an active department of an entry gives."""
    return F.coalesce(*[F.when(true_of(f"e.{d}.IsActive"), value(f"e.{d}")) for d in _DEPARTMENTS])


def _place(name: str) -> Callable[[], Column]:
    """A field of the address of the first active department that has a suburb."""
    return lambda: _active(lambda d: F.when(F.coalesce(F.col(f"{d}.Address.Suburb"), F.lit("")) != "", F.struct(F.col(f"{d}.Address.{name}").alias("v"))))["v"]


def _trimmed(column: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.nullif(F.trim(column()), F.lit(""))


def _email_of(department: str) -> Column:
    found = F.array(*[F.lower(F.trim(F.col(f"{department}.Contact.Email{k}"))) for k in (1, 2, 3)])
    return F.get(F.filter(found, lambda v: F.coalesce(F.contains(v, F.lit("@")), F.lit(False))), F.lit(0))


def _site_of(department: str) -> Column:
    """The site as an object with a Url, or as it is."""
    site = F.col(f"{department}.Contact.Website")
    return F.nullif(F.when(site.startswith("{"), F.get_json_object(site, "$.Url")).otherwise(site), F.lit(""))


register("isuzu", _simple("Dealers", name="Name", keep=lambda: true_of("e.IsActive"), paths=("IsActive", *(f"{d}.{f}" for d in _DEPARTMENTS for f in ("IsActive", "Address.Suburb", "Address.State", "Address.Street", "Address.PostCode", "Contact.Website", "Contact.Phone", "Contact.Email1", "Contact.Email2", "Contact.Email3"))), more={
    "suburb": _trimmed(_place("Suburb")), "address": _trimmed(_place("Street")), "postcode": _trimmed(_place("PostCode")),
    "state": lambda: state_of(_trimmed(_place("State"))()), "phone": lambda: _active(lambda d: F.nullif(F.col(f"{d}.Contact.Phone"), F.lit(""))),
    "website_url": lambda: _active(_site_of), "api_email": lambda: _active(_email_of)}))


def _location(name: str) -> Callable[[], Column]:
    """A field of the first location that is primary, else of the first one."""
    primary = lambda: F.filter("e.Locations", lambda x: F.coalesce(F.lower(x["isPrimary"]) == "true", F.lit(False)))
    return lambda: F.nullif(F.trim(F.coalesce(F.get(primary(), F.lit(0)), F.get("e.Locations", F.lit(0)))[name]), F.lit(""))


HONDA_SITE = "https://www.honda.com.au"
register("honda", _simple(name="Name", state="State", paths=("Website", *(f"Locations[].{f}" for f in ("isPrimary", "AddressLine1", "AddressSuburb", "AddressPostcode", "Phone"))), more={
    "address": _location("AddressLine1"), "suburb": _location("AddressSuburb"), "postcode": _location("AddressPostcode"), "phone": _location("Phone"),
    "website_url": lambda: F.when(text("e.Website").startswith("http"), text("e.Website")).otherwise(F.concat(F.lit(HONDA_SITE), text("e.Website")))}))
register("subaru", _simple(name="name", state="state", keep=lambda: true_of("e.isActive"), paths=("isActive", *(f"dealerDetails[].{f}" for f in ("suburb", "url", "address", "postCode", "phone", "email"))), more={
    **{c: (lambda f=f: F.nullif(F.trim(F.get("e.dealerDetails", F.lit(0))[f]), F.lit(""))) for c, f in (("suburb", "suburb"), ("website_url", "url"), ("address", "address"), ("postcode", "postCode"), ("phone", "phone"))},
    "api_email": lambda: F.nullif(F.lower(F.trim(F.get("e.dealerDetails", F.lit(0))["email"])), F.lit(""))}))
register("bmw", _simple("data.pois", lower="attributes.mail", name="name", address="street", suburb="city", postcode="postalCode", phone="attributes.phone", website_url="attributes.homepage", paths=("state",), more={"state": lambda: state_of(text("e.state"))}))
register("mercedes", _simple("dealers", name="legalName", address="address.addressLine1", suburb="address.city", postcode="address.postalCode", website_url="url", paths=("address.stateProvince", "address.region", "contact"), more={
    "state": lambda: either("e.address.stateProvince", "e.address.region"),
    "phone": lambda: F.when(F.col("e.contact").startswith("{"), text_of_json("e.contact", "phone"))}))
register("ldv", _simple("result.data.allCmsBrandDealer.nodes", lower="email", name="name", address="address", suburb="suburb", state="state", postcode="postcode", phone="phone", paths=("contactUrl", "url"), more={"website_url": lambda: either("e.contactUrl", "e.url")}))
register("volkswagen", _simple("dealers", "dealer.dealerCode", name="dealer.dealerName", suburb="dealer.SalesSuberbCode", state="dealer.dealerState", website_url="dealer.dealerWebsite", paths=tuple(f"dealer.{f}" for f in ("SalesStreetCode", "dealerAddress", "SalesPostCode", "dealerPostcode", "SalesPhoneCode", "phone", "SalesEmailCode", "FinanceEmail")), more={
    "address": lambda: either("e.dealer.SalesStreetCode", "e.dealer.dealerAddress"), "postcode": lambda: either("e.dealer.SalesPostCode", "e.dealer.dealerPostcode"),
    "phone": lambda: either("e.dealer.SalesPhoneCode", "e.dealer.phone"), "api_email": lambda: F.coalesce(lowered("e.dealer.SalesEmailCode"), lowered("e.dealer.FinanceEmail"))}))
register("jeep", _simple("dealers", "id", name="name", address="address.line1", suburb="address.city", state="address.state", postcode="address.postal_code", phone="phone", website_url="web_site"))
_PLACE = r",\s*(.+?)\s+(NSW|VIC|QLD|SA|WA|TAS|NT|ACT)\s+(\d{4})$"
register("mg", Mapping(["Name", "Dealer_Name", "Dealer_State", "Showroom_Address", "Phone_Number", "MG_Website"], {
    "name": lambda: either("e.Name", "e.Dealer_Name"), "state": lambda: either("e.Dealer_State", "_state"), "address": lambda: text("e.Showroom_Address"), "phone": lambda: text("e.Phone_Number"), "website_url": lambda: text("e.MG_Website"),
    "suburb": lambda: F.nullif(F.trim(F.regexp_extract(text("e.Showroom_Address"), _PLACE, 1)), F.lit("")), "postcode": lambda: F.nullif(F.regexp_extract(text("e.Showroom_Address"), _PLACE, 3), F.lit(""))},
    "result.Dealer_List", by_state=True, keep=lambda: ~F.col("p.code").eqNullSafe("2955")))
# Street types and the badges of a card.
STREETS = "St|Rd|Ave|Hwy|Dr|Pl|Cres|Ct|Way|Blvd|Tce|Pde|Lane|Ln|Circuit|Crescent|Street|Road|Avenue|Highway|Drive|Place|Court|Terrace|Parade"
BADGES = ["Experience Centre", "Megastore", "Service Centre", "Closest"]
_TOWN = r"[^,]*),\s*([A-Za-z\s]+?)\s+(NSW|VIC|QLD|SA|WA|TAS|NT|ACT)\s+(\d{4})"


def address_in_card(whole: Column, name: Column) -> dict[str, Column]:
    """Address in a card's text: from a house number to a street type; else what stands before the comma, without the
    card's name and badges."""
    street, loose = rf"(?i)(\d+[\w\s/-]+(?:{STREETS}){_TOWN}", _TOWN.replace("[^,]*)", "([^,]+)")
    got = lambda i: F.coalesce(F.nullif(F.regexp_extract(whole, street, i), F.lit("")), F.nullif(F.regexp_extract(whole, loose, i), F.lit("")))
    rest = F.trim(F.regexp_extract(whole, loose, 1))
    rest = F.when(rest.startswith(name), F.substr(rest, F.length(name) + 1)).otherwise(rest)
    for badge in BADGES:
        rest = F.trim(F.replace(rest, F.lit(badge)))
    exact = F.nullif(F.trim(F.regexp_extract(whole, street, 1)), F.lit(""))
    return {"address": F.when(got(4).isNotNull(), F.coalesce(exact, rest)), "suburb": F.trim(got(2)), "state": F.upper(got(3)), "postcode": got(4)}


register("byd", _simple(name="name", website_url="website", paths=("rawText",), more={c: (lambda c=c: address_in_card(F.coalesce("e.rawText", F.lit("")), text("e.name"))[c]) for c in ("address", "suburb", "state", "postcode")}))


def address_by_count(whole: Column) -> dict[str, Column]:
    """Street, suburb, state and postcode of four parts or more, or of three whose last is 'STATE 3000'; else the whole."""
    parts = F.transform(F.split(F.coalesce(whole, F.lit("")), ","), lambda x: F.trim(x))
    get, last, four = lambda i: F.get(parts, F.lit(i)), r"^([A-Z]{2,3})\s*(\d{4})", F.size(parts) >= 4
    three = (F.size(parts) == 3) & F.coalesce(get(2).rlike(last), F.lit(False))
    return {"address": F.when(four | three, get(0)).otherwise(whole), "suburb": F.when(four | three, get(1)), "state": F.when(four, get(2)).when(three, F.regexp_extract(get(2), last, 1)), "postcode": F.when(four, get(3)).when(three, F.regexp_extract(get(2), last, 2))}


register("gwm", _simple(once="name", lower="email", name="name", phone="phone", paths=("address",), more={c: (lambda c=c: address_by_count(F.col("e.address"))[c]) for c in ("address", "suburb", "state", "postcode")}))


def text_of_json(path: str, name: str) -> Column:
    """A field of what may be an object or plain text."""
    return F.nullif(F.trim(F.get_json_object(F.col(path), f"$.{name}")), F.lit(""))
