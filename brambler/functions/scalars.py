"""Scalar functions as column expressions; all stay inside generated code."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), worked out once: for long expressions that a rule needs many times."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))  # of one argument: a second one would be taken for the place


def first_contained(text: Column, table: dict[str, str]) -> Column:
    """The value of the first key that a text contains."""
    hits = [F.when(F.contains(text, F.lit(k)), F.lit(v)) for k, v in table.items()]
    return F.coalesce(*hits)


def role_normalised(raw: Column, roles: dict[str, str] = vocab.ROLES) -> Column:
    return first_contained(F.lower(F.trim(raw)), roles)


def role_found(text: Column, roles: dict[str, str] = vocab.ROLES) -> Column:
    """The first of the known titles that a text contains, as it is listed."""
    return first_contained(F.lower(text), {k: k for k in roles})


def role_plausible(raw: Column, words: list[str] = vocab.ROLE_KEYWORDS) -> Column:
    """4 to 60 characters, and a keyword that stands, where it first does, at the start or behind one of - / & and a comma."""
    text = F.lower(F.trim(raw))

    def fits(word: Column) -> Column:
        at = F.instr(text, word)
        return (at > 0) & F.rtrim(F.substring(text, F.lit(1), at - 1)).rlike("^$|[-/&,]$")

    return F.coalesce(F.length(text).between(4, 60) & F.exists(F.array(*map(F.lit, words)), fits), F.lit(False))


def name_key(*parts: Column) -> Column:
    """Words of over one letter, sorted; empty if there are fewer than two. Only a-z count."""
    whole = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    words = F.filter(F.split(F.regexp_replace(whole, "[^a-z ]", " "), " +"), lambda w: F.length(w) > 1)
    return F.when(F.size(words) >= 2, F.array_join(F.array_sort(words), " ")).otherwise("")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]", "")


def local_part(email: Column) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(1))


def domain_part(email: Column) -> Column:
    """What stands after the first @; empty without one."""
    return F.split_part(email, F.lit("@"), F.lit(2))


def site_domain(url: Column) -> Column:
    """The authority of a URL with port and case, without a leading www."""
    netloc = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.nullif(F.regexp_replace(netloc, r"^www\.", ""), F.lit(""))


def geo_band(domain: Column) -> Column:
    d = F.trim(F.substring_index(F.lower(F.coalesce(domain, F.lit(""))), ";", 1))
    return F.when(d.endswith(".au"), "AU").when(F.length(F.substring_index(d, ".", -1)) == 2, "INTL").otherwise("COM")


def is_role_inbox(email: Column, pattern: str = vocab.ROLE_INBOX) -> Column:
    return F.lower(local_part(F.coalesce(email, F.lit("")))).rlike(pattern)


def domain_words(domain: Column) -> Column:
    return F.regexp_extract_all(F.lower(domain), F.lit("[a-z0-9]+"), F.lit(0))


def proximity_tier(source: Column, domain: Column) -> Column:
    d, words = F.lower(domain), domain_words(domain)
    among = lambda table: F.arrays_overlap(words, F.array(*map(F.lit, table)))
    return (
        F.when(source == "team_page", "dealer")
        .when(F.coalesce(domain, F.lit("")) == "", "T4")
        .when(d.isin(vocab.FREEMAIL), "T4")
        .when(d.isin(vocab.IMPORTERS) | among(vocab.MAKERS), "T1")
        .when(d.isin(vocab.BODIES) | among(vocab.SUPPLIERS), "T2")
        .when(among(vocab.AGENCIES), "T3")
        .otherwise("T4")
    )


def split_first_rest(name: Column) -> tuple[Column, Column]:
    """The first word, and all others as one string (null if there is none)."""
    words = F.split(F.trim(name), r"\s+")
    rest = F.when(F.size(words) > 1, F.array_join(F.slice(words, 2, F.size(words)), " "))
    return F.get(words, F.lit(0)), rest


def split_at_first(name: Column) -> tuple[Column, Column]:
    """What stands before and behind the first blank; null where nothing does."""
    at = F.instr(name, " ")
    first = F.when(at > 0, F.substring(name, F.lit(1), at - 1)).otherwise(name)
    return F.nullif(first, F.lit("")), F.when(at > 0, F.nullif(F.substring(name, at + 1, F.length(name)), F.lit("")))


def split_first_last(name: Column) -> tuple[Column, Column]:
    words = F.split(F.trim(name), r"\s+")
    return F.get(words, F.lit(0)), F.when(F.size(words) > 1, F.element_at(words, -1))


def generated_local(pattern: Column, first: Column, last: Column) -> Column:
    """The local part that a pattern gives a name; null if a part it needs is empty."""
    clean = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "['\\- ]", "")
    f, n = clean(first), clean(last)
    i, j = F.substring(f, 1, 1), F.substring(n, 1, 1)
    forms = {"first.last": F.concat(f, F.lit("."), n), "first_last": F.concat(f, F.lit("_"), n), "flast": F.concat(i, n), "firstl": F.concat(f, j), "lastf": F.concat(n, i), "last.first": F.concat(n, F.lit("."), f), "firstlast": F.concat(f, n)}
    whole = functools.reduce(lambda c, kv: c.when(pattern == kv[0], F.when(n != "", kv[1])), forms.items(), F.when(pattern == "first", f))
    return F.when(f != "", whole)


def known_prefixes(first: Column, last: Column) -> Column:
    """Local parts that a person's known address may have, in the order in which they are tried."""
    clean = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "['\\-]", "")
    f, n = clean(first), clean(last)
    i, j = F.substring(f, 1, 1), F.substring(n, 1, 1)
    dot, line = F.lit("."), F.lit("_")
    return F.when(f != "", F.array(F.concat(f, dot, n), F.concat(i, n), f, F.concat(f, j), F.concat(n, dot, f), F.concat(n, i), F.concat(f, line, n), F.concat(f, n)))


def detected_format(first: Column, last: Column, local: Column) -> Column:
    f, n, own = slug(first), slug(last), F.lower(local)
    i, j = F.substring(f, 1, 1), F.substring(n, 1, 1)
    forms = [("first.last", F.concat(f, F.lit("."), n)), ("first_last", F.concat(f, F.lit("_"), n)), ("flast", F.concat(i, n)), ("firstl", F.concat(f, j)), ("firstlast", F.concat(f, n)), ("last.first", F.concat(n, F.lit("."), f)), ("lastf", F.concat(n, i))]
    return F.when((f != "") & (n != ""), F.coalesce(*[F.when(own == form, F.lit(name)) for name, form in forms]))


def mx_provider(hosts: Column) -> Column:
    """What exchangers' names, joined by blanks, tell of the provider."""
    joined = F.lower(F.array_join(hosts, " "))
    small = functools.reduce(operator.or_, [F.contains(joined, F.lit(k)) for k in vocab.SMALL_HOSTS])
    return F.coalesce(first_contained(joined, vocab.GATEWAYS), F.when(F.contains(joined, F.lit("secureserver")), "GoDaddy"), F.when(small, "cPanel-ish"), F.lit("other/self"))


def is_gateway(provider: Column) -> Column:
    return provider.isin(sorted(set(vocab.GATEWAYS.values())))


def rcpt_verdict(catchall_code: Column, code: Column) -> Column:
    return F.when(catchall_code.isin(250, 251), "catchall").when(code.isin(250, 251), "deliverable").when(code.isin(550, 551, 553), "undeliverable").otherwise("unknown")


def release_company(detail: Column) -> Column:
    """The client in 'newspress: client — title'."""
    after = F.regexp_extract(detail, "newspress: (.*)", 1)
    return F.when(F.like(detail, F.lit("newspress: % — %")), F.nullif(F.trim(F.split_part(after, F.lit(" — "), F.lit(1))), F.lit("")))


def local_day(at: Column, zone: str = "Australia/Melbourne") -> Column:
    """The date in a time zone of an instant (a timestamp without zone is taken as UTC)."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), at.cast("timestamp_ntz")), "yyyy-MM-dd")


#: Lower-case addresses that clean_address() leaves as they are: the usual form, no file's name.
PLAIN_ADDRESS = r"^[a-z0-9%][a-z0-9._%+\-]*@[a-z0-9.\-]*\.(?!(?:png|jpe?g|gif|svg|webp|bmp|ico|css|js|woff2?|ttf)\z)[a-z]{2,}\z"


def clean_address(raw: Column) -> Column:
    """A matched address without marks around it; null if it is none or a file's name."""
    text = F.regexp_replace(F.lower(F.trim(raw)), r"^[.,;:<>()\[\]\"']+|[.,;:<>()\[\]\"']+$", "")
    parts = let(text, lambda t: F.struct(F.regexp_replace(local_part(t), r"^[\-._+]+", "").alias("local"), F.regexp_extract(t, "@(.*)$", 1).alias("domain")))

    def whole(p: Column) -> Column:
        bad = (p["local"] == "") | ~F.contains(p["domain"], F.lit(".")) | p["domain"].rlike(r"(?i)\.(png|jpe?g|gif|svg|webp|bmp|ico|css|js|woff2?|ttf)$")
        return F.when(~bad, F.concat(p["local"], F.lit("@"), p["domain"]))

    return let(F.lower(F.trim(raw)), lambda t: F.when(t.rlike(PLAIN_ADDRESS), t).otherwise(let(parts, whole)))
