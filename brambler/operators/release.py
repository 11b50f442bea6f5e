"""Releases and cross-organisation passes: cut-offs, contact tables, latest captures, pattern pass."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import clean_address, detected_format, domain_part, let, local_part, role_normalised, site_domain, split_first_last
from . import people, read
from .mail import appointees, in_house, made_local, name_near, name_of_local, person_name, place_of, release_name, roles_in, window_of
from .tree import Element, tree


def until_older(rows: DataFrame, key: str, cutoff: Column, date: str = "release_date", pos: str = "list_pos") -> DataFrame:
    """Rows of each newest-first list before its first one older than the cut-off; a plain filter would differ where the
    list isn't in order. Undated rows don't end a list."""
    seen = F.max(F.when(F.col(date) < cutoff, 1).otherwise(0)).over(Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("__old", seen).filter("__old = 0").drop("__old")


def release_list(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """list_name, list_pos and release_id of lists read page by page (list_name, page, last_page, ids), newest first.

    Reading stops behind the first page without ids, at the last page that a page tells of (null: unknown) and at max_pages;
    a missing page ends a list too. Null ids are none. An id that comes again, on whatever page, keeps its first place.
    """
    pages = pages.filter("page >= 1") if max_pages is None else pages.filter(F.col("page").between(1, max_pages))
    so_far = Window.partitionBy("list_name").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ends = (F.coalesce(F.size("ids"), F.lit(0)) <= 0) | F.coalesce(F.col("page") >= F.col("last_page"), F.lit(False))
    read_on = pages.withColumn("__ended", F.coalesce(F.max(ends).over(so_far), F.lit(False))).withColumn("__n", F.count("*").over(so_far))
    rows = read_on.filter(~F.col("__ended") & (F.col("page") == F.col("__n") + 1)).select("list_name", "page", F.posexplode("ids").alias("place", "release_id")).filter("release_id is not null")
    first = rows.groupBy("list_name", "release_id").agg(F.min(F.struct("page", "place")).alias("first"))
    return first.select("list_name", F.row_number().over(Window.partitionBy("list_name").orderBy("first")).alias("list_pos"), "release_id")


def months_before(as_of: Column, months: float) -> Column:
    """A cut-off by days, 30.44 for each month."""
    return F.date_sub(as_of, F.floor(F.lit(months * 30.44)).cast("int"))


def latest_captures(rows: DataFrame) -> DataFrame:
    """One row for each address: its first capture's fields, and the latest date of all."""
    rest = [c for c in rows.columns if c not in ("email", "source_date")]
    first = F.min_by(F.struct(*rest), "seq").alias("first")
    return rows.groupBy("email").agg(first, F.max("source_date").alias("source_date")).select("email", "source_date", "first.*")


def _cell(cell: Element) -> tuple[bool, str]:
    for x in cell.walk():
        if x.tag == "a" and x.attrs.get("href", "").lower().startswith("mailto:"):
            return True, x.attrs["href"][7:]
    return False, cell.text(" ", strip=True)


def _tables(root: Element) -> list[list[list[tuple[bool, str]]]]:
    """Cells of all tables, row by row, those of tables in a cell among them: a mailto target if a cell has one, else its text."""
    out, tables, rows = [], [], []  # tables and rows that are open
    todo = [(iter(root.items), None)]
    while todo:
        x = next(todo[-1][0], None)
        if x is None:
            among = todo.pop()[1]
            if among is not None:
                among.pop()
        elif not isinstance(x, str):
            among = tables if x.tag == "table" else rows if x.tag == "tr" else None
            if x.tag in ("td", "th"):
                cell = _cell(x) if rows else None
                for row in rows:
                    row.append(cell)
            elif among is not None:
                own = []
                for table in [out] if x.tag == "table" else tables:
                    table.append(own)
                among.append(own)
            todo.append((iter(x.items), among))
    return out


#: Releases that are trees at a time.
AT_ONCE = 256
TABLES = pa.list_(pa.list_(pa.list_(pa.struct([("mail", pa.bool_()), ("value", pa.string())]))))


def read_releases(releases: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """release_id, columns to keep, text and tables (rows of cells) of each release's HTML; null is an empty release."""
    keep = ["release_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, AT_ONCE) for k in range(0, whole.num_rows, AT_ONCE)):
                texts, tables = [], []
                for html in batch["content_html"].to_pylist():
                    root = tree(html)
                    texts.append(root.text(" "))
                    tables.append(_tables(root) if "<table" in (html or "").lower() else [])
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(texts, pa.string()), pa.array(tables, TABLES)], [*keep, "text", "tables"])

    kinds = dict(releases.dtypes)
    return releases.select(*keep, "content_html").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string", "tables array<array<array<struct<mail:boolean,value:string>>>>"]))


def cell_name(text: Column) -> Column:
    """Two or three capitalised words, none of a role, label or company."""
    return text.rlike(r"^[A-Z][a-zA-Z'\-]+(\s+[A-Z][a-zA-Z'\-]+){1,2}$") & release_name(text)


def table_contacts(table: Column) -> Column:
    """Names and addresses of a table of contacts, by column: an address below a name belongs to it. The row of addresses is
    the first behind the heading of contacts, if there is one, and that of names the first between these two."""
    first = lambda rows, test: F.array_position(F.transform(rows, test), F.lit(True))  # noqa: E731  1 for the first, 0 for none
    told = lambda row: F.array_join(F.transform(row, lambda c: c["value"]), " ")
    holds = lambda row: F.exists(row, lambda c: F.contains(c["value"], F.lit("@")))
    names = lambda row: F.exists(row, lambda c: cell_name(c["value"]))
    written = lambda c: F.when(c["mail"], c["value"]).otherwise(F.regexp_extract(c["value"], vocab.EMAIL, 0))

    def of_rows(rows: Column, at: Column) -> Column:
        above = F.get(F.filter(F.slice(rows, F.lit(1), at - 1), names), F.lit(0))
        named = lambda own: let(own, lambda name: F.when(cell_name(name), name))
        return let(above, lambda row: F.transform(F.get(rows, at - 1), lambda c, i: F.struct(named(F.get(row, i)["value"]).alias("name"), clean_address(written(c)).alias("email"))))

    header = first(table, lambda row: told(row).rlike(vocab.CONTACT_HEADER))
    body = let(header, lambda at: F.slice(table, at + 1, F.size(table) + 1))
    found = let(body, lambda rows: let(first(rows, holds), lambda at: F.when(at > 0, of_rows(rows, at))))
    return F.filter(F.coalesce(found, F.array().cast("array<struct<name:string,email:string>>")), lambda c: c["email"].isNotNull())


def contacts_of(tables: Column) -> Column:
    return F.flatten(F.transform(tables, table_contacts))


def contact_tables(releases: DataFrame) -> DataFrame:
    """release_id, seq, name and email of contact tables in a release's HTML."""
    return read_releases(releases).select("release_id", F.posexplode(contacts_of(F.col("tables"))).alias("seq", "c")).select("release_id", "seq", "c.name", "c.email")


def people_of(text: Column, tables: Column, self_domains: tuple[str, ...] = ()) -> Column:
    """email, full_name, role_raw (the words found) and role of the people whose addresses stand in a release.

    A name is the table's, else two words of the address, else the nearest name before it in the text; without one, or
    with a word of a role, label or company in it, an address is dropped, as are shared inboxes, free mail and tokens.
    """
    person = lambda name: F.when(person_name(name), name)

    def allowed(email: Column) -> Column:
        return let(F.struct(local_part(email).alias("local"), domain_part(email).alias("domain")), lambda p: people.press_reject_reason(p["local"], p["domain"], self_domains).isNull())

    def one(email: Column, contacts: Column, lower: Column) -> Column:
        in_table = F.get(F.filter(contacts, lambda c: c["email"] == email), F.lit(0))["name"]  # of its first place, named or not
        name = lambda at: F.coalesce(in_table, let(name_of_local(local_part(email)), person), let(name_near(text, at), person))
        full = lambda at: let(name(at), lambda own: F.when(release_name(own), own))
        return let(place_of(email, lower), lambda at: F.struct(email.alias("email"), full(at).alias("full_name"), at.alias("at")))

    def role(p: Column) -> Column:
        return let(roles_in(window_of(text, p["at"])), lambda r: F.struct(p["email"].alias("email"), p["full_name"].alias("full_name"), r["role_raw"].alias("role_raw"), r["role"].alias("role")))

    def every(contacts: Column) -> Column:
        written = F.transform(F.regexp_extract_all(text, F.lit(vocab.EMAIL), F.lit(0)), clean_address)
        emails = F.array_distinct(F.filter(F.concat(F.transform(contacts, lambda c: c["email"]), written), lambda e: e.isNotNull()))
        found = let(F.lower(text), lambda lower: F.transform(F.filter(emails, allowed), lambda e: one(e, contacts, lower)))
        return F.transform(F.filter(found, lambda p: p["full_name"].isNotNull()), role)

    return let(contacts_of(tables), every)


def release_people(releases: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """release_id and people_of() each release."""
    return read_releases(releases).select("release_id", F.inline(people_of(F.col("text"), F.col("tables"), self_domains)))


def guesses_of(client: Column, shown: Column, named: Column, self_domains: tuple[str, ...] = ()) -> Column:
    """email, name, role_raw and pattern of what one release lets guess: the formats of its people's addresses at the client's
    own domains, where a domain has exactly one, give the addresses of its appointees."""
    form = lambda p: let(p["full_name"], lambda name: detected_format(*split_first_last(name), local_part(p["email"])))
    formats = F.transform(F.filter(shown, lambda p: in_house(client, domain_part(p["email"]))), lambda p: F.struct(domain_part(p["email"]).alias("domain"), form(p).alias("pattern")))
    formats = F.array_distinct(F.filter(formats, lambda f: f["pattern"].isNotNull()))
    single = lambda all_: F.filter(all_, lambda f: F.size(F.filter(all_, lambda g: g["domain"] == f["domain"])) == 1)

    def guess(a: Column, f: Column) -> Column:
        local = made_local(a["name"], f["pattern"])
        kept = lambda own: F.when(people.press_reject_reason(own, f["domain"], self_domains).isNull(), F.concat(own, F.lit("@"), f["domain"]))
        return F.struct(let(local, kept).alias("email"), a["name"].alias("name"), a["role"].alias("role_raw"), f["pattern"].alias("pattern"))

    made = let(let(formats, single), lambda fs: F.flatten(F.transform(named, lambda a: F.transform(fs, lambda f: guess(a, f)))))
    return F.filter(made, lambda g: g["email"].isNotNull())


def _told(releases: DataFrame, keep: tuple[str, ...], self_domains: tuple[str, ...]) -> DataFrame:
    """keep, shown (people_of), named (appointees) and made (guesses_of) of each release, which is read once."""
    rows = read_releases(releases, ("client_name", "title", *keep))
    told = F.struct(people_of(F.col("text"), F.col("tables"), self_domains).alias("shown"), appointees(F.trim("title"), F.col("text")).alias("named"))
    made = let(told, lambda t: F.struct(t["shown"].alias("shown"), t["named"].alias("named"), guesses_of(F.col("client_name"), t["shown"], t["named"], self_domains).alias("made")))
    return rows.select("release_id", *keep, F.inline(F.array(made)))


def appointee_addresses(releases: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """What releases that appoint somebody let one guess: email, name, role_raw, role, pattern and release_date.

    releases: release_id (one row each), client_name, title, content_html, release_date. The people whose addresses a
    release shows, if these are at the client's own domain, tell the format of addresses there; where all of them at a
    domain have the same, it gives the appointees' addresses. An address once found stays with the release found first
    (list_pos), with the latest date of all; one that any release shows is no guess.
    """
    rows = _told(releases, ("list_pos", "release_date"), self_domains)
    made = F.transform("made", lambda g: F.struct(g["email"].alias("email"), g.alias("guess")))
    shown = F.transform("shown", lambda p: F.struct(p["email"].alias("email"), F.lit(None).cast("struct<email:string,name:string,role_raw:string,pattern:string>").alias("guess")))
    rows = rows.select("release_id", "list_pos", "release_date", F.inline(F.concat(made, shown)))
    place = F.when(F.col("guess").isNotNull(), F.struct("list_pos", "release_id", F.col("guess.name").alias("name"), F.col("guess.pattern").alias("pattern")))
    found = rows.groupBy("email").agg(F.min_by("guess", place).alias("own"), F.max("release_date").alias("release_date"), F.max(F.col("guess").isNull()).alias("shown"))
    return found.filter("not shown").select("email", "own.name", "own.role_raw", "own.pattern", "release_date").withColumn("role", role_normalised(F.col("role_raw")))


def release_counts(releases: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """One row of counters of a run over releases: releases, missing, candidates, contacts, releases that appoint, people
    appointed, guesses and those among all that were made that some release shows."""
    rows = _told(releases.withColumn("there", F.col("content_html").isNotNull()), ("there",), self_domains)
    names = ("there", "missing", "appoints", "named", "shown", "made")
    line = lambda email, *counts: F.struct(email.alias("email"), *[c.cast("long").alias(n) for n, c in zip(names, counts, strict=True)])
    nil, one = F.lit(0), F.lit(1)
    own = line(F.lit(None).cast("string"), F.col("there"), ~F.col("there"), F.size("named") > 0, F.size("named"), nil, nil)
    shown, made = F.transform("shown", lambda p: line(p["email"], nil, nil, nil, nil, one, nil)), F.transform("made", lambda g: line(g["email"], nil, nil, nil, nil, nil, one))
    # a line for a release and one for each address: those of equal addresses meet, so that each is known as shown, made or both
    lines = rows.select(F.inline(F.concat(F.array(own), shown, made))).groupBy("email").agg(*[F.sum(n).alias(n) for n in names])
    total = lambda n: F.coalesce(F.sum(n), F.lit(0).cast("long"))
    return lines.agg(
        total("there").alias("releases"), total("missing").alias("missing"), total("shown").alias("candidates"), F.count_if(F.col("shown") > 0).alias("contacts"),
        total("appoints").alias("appointment_releases"), total("named").alias("appointees_named"), F.count_if((F.col("made") > 0) & (F.col("shown") == 0)).alias("extrapolated"),
    )


def release_contacts(releases: DataFrame, tables: DataFrame) -> DataFrame:
    """Addresses of a release: those of its tables with their names, then all others in its text."""
    text = F.regexp_replace("content_html", "<[^>]+>", " ")
    found = releases.select("release_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(vocab.EMAIL), F.lit(0)))).alias("email"))
    rest = found.join(tables.select("release_id", "email").distinct(), ["release_id", "email"], "left_anti").withColumn("name", F.lit(None).cast("string"))
    named = tables.select("release_id", "email", F.when(~F.lower("name").isin(vocab.LABELS), F.col("name")).alias("name"))
    return named.groupBy("release_id", "email").agg(F.min("name").alias("name")).unionByName(rest)


def pattern_pass(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    """Addresses for people of an organisation who have none: the pattern comes from its own addresses, else from those
    of its site's domain; whoever's address is taken already stays without. Gives id, email, confidence, pattern."""
    own = contacts.filter("email is not null and dealership_id is not null").select(F.col("dealership_id").alias("grp"), "email", F.col("id").alias("seq"))
    site = dealerships.select(F.col("id").alias("dealership_id"), F.lower(site_domain(F.col("website_url"))).alias("site"))
    by_site = contacts.filter("email is not null").select(F.lower("email_domain").alias("grp"), "email", F.col("id").alias("seq"))
    first = people.infer_patterns(own, "grp").filter("pattern is not null").select(F.col("grp").alias("dealership_id"), F.struct("pattern", "domain").alias("first"))
    second = people.infer_patterns(by_site, "grp").filter("pattern is not null").select(F.col("grp").alias("site"), F.struct("pattern", "domain").alias("second"))
    rows = contacts.filter("email is null and dealership_id is not null and first_name is not null and last_name is not null").select("id", "dealership_id", "first_name", "last_name")
    rows = rows.join(site, "dealership_id", "left").join(first, "dealership_id", "left").join(second, "site", "left")
    best = F.coalesce("first", "second")
    made = people.generate_addresses(rows.withColumns({"pattern": best["pattern"], "domain": best["domain"]})).filter("email is not null")
    # of people who'd get one address the first has it; an address that is known is nobody's to get
    made = made.withColumn("n", F.row_number().over(Window.partitionBy("email").orderBy("id"))).filter("n = 1")
    return made.join(contacts.select("email").filter("email is not null").distinct(), "email", "left_anti").select("id", "email", "confidence", "pattern")


def pattern_pass_levels(contacts: DataFrame, dealerships: DataFrame) -> DataFrame:
    """As pattern_pass(), by three levels: addresses of the organisation itself, of all whose site has its domain, and at
    that domain. The first level with any address decides, even if no pattern comes out of it."""
    site = dealerships.select(F.col("id").alias("dealership_id"), F.lower(site_domain(F.col("website_url"))).alias("site"))
    known = contacts.filter("email is not null and dealership_id is not null").select("dealership_id", "email", "email_domain", F.col("id").alias("seq")).join(site, "dealership_id", "left")
    levels = []
    for n, (key, grp) in enumerate((("dealership_id", F.col("dealership_id")), ("site", F.col("site")), ("site", F.lower("email_domain")))):
        found = people.infer_patterns(known.filter(grp.isNotNull()).select(grp.alias("grp"), "email", "seq"), "grp")
        levels.append((key, found.select(F.col("grp").alias(key), F.struct("pattern", "domain").alias(f"level{n}"))))
    rows = contacts.filter("email is null and dealership_id is not null and first_name is not null and last_name is not null").select("id", "dealership_id", "first_name", "last_name").join(site, "dealership_id", "left")
    for key, found in levels:
        rows = rows.join(found, key, "left")
    best = F.coalesce("level0", "level1", "level2")
    made = people.generate_addresses(rows.withColumns({"pattern": best["pattern"], "domain": best["domain"]})).filter("email is not null")
    made = made.withColumn("n", F.row_number().over(Window.partitionBy("email").orderBy("id"))).filter("n = 1")
    return made.join(contacts.select("email").filter("email is not null").distinct(), "email", "left_anti").select("id", "email", "confidence", "pattern")


def cockpit(contacts: DataFrame, dealerships: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """The three parts of the overview: totals, days of sending, first page by batch."""
    return {"summary": read.summary_totals(contacts, dealerships), "sends": read.sends_by_day(events).orderBy(F.desc("day")).limit(30), "contacts": read.contacts_page(read.with_dealership(contacts, dealerships), "batch", 600)}


# ---- editions


def resolve_tags(html: str) -> str:
    """Conditional tags [if:x]..[else:]..[endif] give their else-branch."""
    html = re.sub(r"\[if:[^\]]*\](?:(?!\[endif\]).)*?\[else:?\]((?:(?!\[endif\]).)*?)\[endif\]", r"\1", html, flags=re.DOTALL)
    html = re.sub(r"\[if:[^\]]*\](?:(?!\[endif\]).)*?\[endif\]", "", html, flags=re.DOTALL)
    if "[if:" in html or "[endif]" in html:
        raise ValueError("a conditional tag is left")
    return html


def remove_div(html: str, marker: str) -> str:
    """html without the balanced div that holds a marker first."""
    at = html.find(marker)
    start = html.rfind("<div", 0, at)
    if at < 0 or start < 0:
        raise ValueError(f"no div with {marker}")
    depth = 0
    for m in re.finditer(r"<(/?)div\b", html[start:]):
        depth += -1 if m[1] else 1
        if not depth:
            end = html.index(">", start + m.start()) + 1
            return html[:start] + html[end:]
    raise ValueError("a div isn't closed")


def edition(html: str, intro: str, place: str, trims: list[str], limit: int = 102_400) -> tuple[str, bool]:
    """An edition with an intro spliced in once, and whether it is under the size from which it gets clipped."""
    html = resolve_tags(html)
    for marker in trims:
        html = remove_div(html, marker)
    if html.count(place) != 1:
        raise ValueError("the place of the intro is not unique")
    html = html.replace(place, place + intro)
    return html, len(html.encode()) < limit


def editions(files: DataFrame, intro: str, place: str, trims: list[str], limit: int = 102_400) -> DataFrame:
    """name, html, fits (under the size from which mail is clipped) and error of files (name, html), an edition each; a
    file that can't be one has its reason in error, and no html."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, html in zip(batch["name"], batch["html"], strict=True):
                try:
                    rows.append((name, *edition(html or "", intro, place, trims, limit), None))
                except ValueError as e:
                    rows.append((name, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["name", "html", "fits", "error"])

    return files.select("name", "html").mapInPandas(run, "name string, html string, fits boolean, error string")
