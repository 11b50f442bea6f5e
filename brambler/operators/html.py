"""What pages hold: addresses, people and links. Only the walk over a page's tree is Python; rules are columns."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import domain_part, local_part, role_plausible
from .tree import FRAME, SILENT, Element, tree

#: Elements that may hold a person, and headings that may be a name: in a card, and anywhere.
CARDS = {"div", "li", "article", "section"}
NAMES_IN_CARDS, NAMES = {"h2", "h3", "h4", "h5", "strong", "b"}, {"h2", "h3", "h4", "h5"}
#: What may hold a role, and how many of these behind a name are looked at.
ROLES, NEAR = {"p", "span", "div"}, 3


def _people(blocks: list[str]) -> list[dict]:
    """Objects of type Person of JSON-LD blocks, names of three letters or more, the first of a name."""
    out, seen = [], set()
    for block in blocks:
        try:
            found = json.loads(block)
        except ValueError:
            continue
        for x in found if isinstance(found, list) else [found]:
            name = str(x.get("name") or "").strip() if isinstance(x, dict) and x.get("@type") == "Person" else ""
            if len(name) >= 3 and name.lower() not in seen:
                seen.add(name.lower())
                phone = x.get("telephone")
                phone = (phone[0] if phone else None) if isinstance(phone, list) else phone
                out.append({"name": name, "role": x.get("jobTitle"), "email": (x.get("email") or "").removeprefix("mailto:").lower() or None, "phone": phone})
    return out


def _headings(root: Element) -> list[dict]:
    """Headings with the texts of the next elements beside them, in page order, and whether they stand in a card."""
    card, out = re.compile("|".join(map(re.escape, vocab.CARD_CLASSES))), []
    skip = SILENT | FRAME
    inside: set[int] = set()  # elements in a card, by identity: their parents come first
    for x in root.walk(skip):
        if id(x.parent) in inside or (x.parent.tag in CARDS and card.search(x.parent.attrs.get("class", "").lower())):
            inside.add(id(x))
        within = id(x) in inside
        if x.tag in NAMES or (within and x.tag in NAMES_IN_CARDS):
            near = [y.text(strip=True, leave=skip) for y in x.following(ROLES, NEAR)]
            out.append({"name": x.text(strip=True, leave=skip), "near": near, "in_card": within, "heading": x.tag in NAMES})
    return out


def _links(root: Element, url: str) -> tuple[list[str], list[dict]]:
    """Targets of mailto links, and all other links with their texts; targets are made absolute."""
    mailtos, links = [], []
    for x in root.walk():
        href = x.attrs.get("href", "").strip() if x.tag == "a" else ""
        if href.lower().startswith("mailto:"):
            mailtos.append(href[7:].split("?")[0])
        elif href and not href.lower().startswith(("#", "tel:")):
            links.append({"href": urljoin(url or "", href), "text": x.text().strip()})
    return mailtos, links


def _blocks(root: Element) -> list[str]:
    return ["".join(t for t in x.items if isinstance(t, str)) for x in root.walk() if x.tag == "script" and x.attrs.get("type", "").lower() == "application/ld+json"]


#: What parse_pages() can give, and how each is got from a page's tree and address.
PARTS = {
    "text": ("string", lambda root, url: root.text(" ")),
    "content": ("string", lambda root, url: root.text(leave=SILENT | FRAME)),
    "mailtos": ("array<string>", lambda root, url: _links(root, url)[0]),
    "links": ("array<struct<href:string,text:string>>", lambda root, url: _links(root, url)[1]),
    "people": ("array<struct<name:string,role:string,email:string,phone:string>>", lambda root, url: _people(_blocks(root))),
    "headings": ("array<struct<name:string,near:array<string>,in_card:boolean,heading:boolean>>", lambda root, url: _headings(root)),
}


def parse_pages(pages: DataFrame, key: str = "page_id", base: str = "url", parts: tuple[str, ...] = tuple(PARTS)) -> DataFrame:
    """key and url of each page with parts of it: visible text, content outside frames, mailto targets, links (absolute),
    people of structured data, headings. Null pages are empty ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, url, html in zip(batch[key], batch[base], batch["html"], strict=True):
                root = tree(html)
                rows.append((k, url, *[PARTS[p][1](root, url) for p in parts]))
            yield pd.DataFrame(rows, columns=[key, base, *parts])

    kind = dict(pages.dtypes)
    return pages.select(key, base, "html").mapInPandas(run, ", ".join([f"{key} {kind[key]}", f"{base} {kind[base]}", *(f"{p} {PARTS[p][0]}" for p in parts)]))


def emails_in_text(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Distinct (key, email) of a column of text; names of pictures don't count."""
    found = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(vocab.EMAIL), F.lit(0)))
    return rows.filter(F.contains(F.col(text), F.lit("@"))).select(key, found.alias("email")).filter(~F.col("email").rlike(r"\.(png|jpg|svg)$")).distinct()


def emails_of_pages(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    targets = parsed.select(key, F.explode("mailtos").alias("email")).select(key, F.lower(F.trim("email")).alias("email")).filter(F.contains("email", F.lit("@")))
    return emails_in_text(parsed, key).union(targets).distinct()


def email_kind(email: Column) -> Column:
    """person or generic; null for the web's own plumbing."""
    domain, local = domain_part(email), local_part(email)
    plumbing = domain.isin(vocab.INFRASTRUCTURE) | domain.rlike(r"\.(" + "|".join(d.replace(".", r"\.") for d in vocab.INFRASTRUCTURE) + ")$")
    generic = local.isin(vocab.GENERIC_LOCALS) | local.rlike("|".join(f"({p})" for p in vocab.GENERIC_PATTERNS))
    return F.when(~plumbing, F.when(generic, "generic").otherwise("person"))


def jsonld_people(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    return parsed.select(key, F.posexplode("people").alias("seq", "p")).select(key, "seq", "p.*")


def card_people(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """key, seq, name and role of a page's people: names in cards, with a role if one is near; if there are none, headings
    that a role follows; without these, 'Name - Role' in the text. A name counts once, where it first stands."""
    role = lambda h: F.get(F.filter(h["near"], lambda t: role_plausible(t)), F.lit(0))
    named = F.filter(F.transform("headings", lambda h, i: F.struct(i.alias("seq"), h["name"].alias("name"), role(h).alias("role"), h["in_card"].alias("in_card"), h["heading"].alias("heading"))), lambda h: F.coalesce(name_plausible(h["name"]), F.lit(False)))
    pair = [F.regexp_extract_all("content", F.lit(vocab.NAME_AND_ROLE), F.lit(k)) for k in (1, 2)]
    told = F.filter(F.zip_with(*pair, lambda n, r: F.struct(n.alias("name"), F.trim(r).alias("role"))), lambda p: name_plausible(p["name"]) & role_plausible(p["role"]))
    told = F.transform(told, lambda p, i: F.struct(i.alias("seq"), p["name"].alias("name"), p["role"].alias("role")))
    rows = parsed.select(key, named.alias("named"), told.alias("told"))
    plain = lambda c: F.transform(c, lambda h: F.struct(h["seq"].alias("seq"), h["name"].alias("name"), h["role"].alias("role")))
    rows = rows.select(key, "told", plain(F.filter("named", lambda h: h["in_card"])).alias("cards"), plain(F.filter("named", lambda h: h["heading"] & h["role"].isNotNull())).alias("headings"))
    found = F.when(F.size("cards") > 0, F.col("cards")).when(F.size("headings") > 0, F.col("headings")).otherwise(F.col("told"))
    rows = rows.select(key, found.alias("found"))
    names = F.transform("found", lambda p: F.lower(p["name"]))
    rows = rows.select(key, "found", F.posexplode("found").alias("place", "c"))
    return rows.filter(F.array_position(names, F.lower("c.name")) == F.col("place") + 1).select(key, "c.seq", "c.name", "c.role")


def name_plausible(name: Column) -> Column:
    """Two to five words, a capital first; no label, vehicle or dealer, and not more than half of it words of titles."""
    name = F.trim(name)
    lower, words = F.lower(name), F.split(name, r"\s+")
    titles = F.filter(words, lambda w: F.regexp_replace(F.lower(w), "[s,]+$", "").isin(vocab.TITLE_WORDS))
    vehicle = lower.isin(vocab.MODEL_NAMES) | lower.rlike("|".join([rf"^({'|'.join(vocab.MAKES_FIRST)})\b", *vocab.VEHICLE_WORDS]))
    shouted = (F.upper(name) == name) & (F.length(name) > 10)
    shape = F.length(name).between(3, 50) & F.size(words).between(2, 5) & name.rlike(r"^\p{Lu}") & ~name.rlike(r"[@()$%!?#+]") & ~name.rlike(r":(\s|$)")
    return shape & ~shouted & ~vehicle & ~lower.isin([*vocab.SKIP_NAMES, *vocab.LABELS]) & ~F.lower(F.element_at(words, -1)).isin(vocab.MAKES_LAST) & (F.size(titles) * 2 <= F.size(words))


def fuse_people(jsonld: DataFrame, cards: DataFrame, key: str = "page_id") -> DataFrame:
    """People of structured data, then those of the page whose name isn't among them."""
    one = jsonld.select(key, "name", "role", "email", F.lit("jsonld").alias("found_in"))
    two = cards.select(key, "name", "role", F.lit(None).cast("string").alias("email"), F.lit("page").alias("found_in"))
    rest = two.withColumn("__n", F.lower("name")).join(one.select(key, F.lower("name").alias("__n")).distinct(), [key, "__n"], "left_anti").drop("__n")
    return one.unionByName(rest)


def link_scores(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """Links of a page to its own site with what speaks for a page about people; the best one comes first."""
    rows = parsed.select(key, F.col("url"), F.posexplode("links").alias("pos", "l")).select(key, "url", "pos", F.lower("l.href").alias("href"), F.lower(F.trim("l.text")).alias("text"))
    netloc = lambda c: F.regexp_extract(c, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    rows = rows.filter(netloc(F.col("href")) == netloc(F.lower("url")))
    path = F.coalesce(*[F.when(F.contains("href", F.lit(p)), F.when(F.col("href").endswith(p) | F.col("href").endswith(p + "/"), 15).otherwise(10)) for p in vocab.TEAM_PATHS], F.lit(0))
    word = F.when(F.col("text").rlike("|".join(vocab.TEAM_WORDS)), 8).otherwise(0)
    score = path + word
    about = F.when((score == 0) & F.contains("href", F.lit("about")) & F.contains("text", F.lit("about")), 2).otherwise(0)
    ending = F.regexp_extract("href", r"^[^?#]*(\.[a-z0-9]+)(?:[?#].*)?$", 1)
    rows = rows.withColumn("score", F.when(ending.isin(vocab.NOT_PAGES), 0).otherwise(score + about)).filter("score > 0")
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "pos"))
    return rows.select(key, "href", "score", best.alias("rank"))


def needs_render(html: Column) -> Column:
    """Whether a page writes its addresses by script: a mailto link without a target."""
    return F.coalesce(html.rlike("(?i)href=[\"']mailto:[\"']"), F.lit(False))
