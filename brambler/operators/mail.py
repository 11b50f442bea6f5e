"""What mail holds: bodies, bounces and absence notes, people and their addresses, releases."""

from __future__ import annotations

import email
import functools
from email.header import decode_header, make_header
from email.utils import getaddresses, parseaddr, parsedate_to_datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import clean_address, domain_part, first_contained, generated_local, let, local_part, slug, split_first_last
from .people import reject_reason
from .tree import tree


def _header(message, name: str) -> str:
    own = message.get(name) or ""
    if isinstance(own, str) and "=?" not in own:
        return own  # no encoded word in it
    try:
        return str(make_header(decode_header(own)))
    except (ValueError, LookupError):
        return own


def _body(message) -> str:
    """The first plain part, else the first HTML part as text; attachments don't count."""
    parts = [p for p in message.walk() if not p.is_multipart() and p.get_content_disposition() != "attachment"]
    for kind in ("text/plain", "text/html"):
        for p in parts:
            if p.get_content_type() == kind:
                raw = p.get_payload(decode=True) or b""
                try:
                    text = raw.decode(p.get_content_charset() or "utf-8", "replace")
                except LookupError:
                    text = raw.decode("utf-8", "replace")
                return text if kind == "text/plain" else tree(text).text("\n")  # entities are read, each text on a line
    return ""


PARSED = "subject string, sender string, sender_name string, sender_address string, reply_to string, auto boolean, sent_on string"


def _parsed(raw: str | None, body: bool) -> tuple:
    m = email.message_from_string((raw or "").lstrip("\r\n"))
    auto = (m.get("Auto-Submitted") or "").strip().lower()
    try:
        day = parsedate_to_datetime(m.get("Date")).date().isoformat()
    except (TypeError, ValueError, AttributeError):
        day = None
    sender = _header(m, "From")
    name, address = parseaddr(sender)
    replies = " ".join(a for _, a in getaddresses([_header(m, "Reply-To")]) if a)
    own = (_header(m, "Subject"), sender, name, address.strip().lower(), replies, bool((auto and auto != "no") or m.get("X-Autoreply") or m.get("X-Autorespond")), day)
    return (*own, _body(m)) if body else own


def parse_messages(messages: DataFrame, body: bool = True) -> DataFrame:
    """msg_id and raw with the headers that matter and the body, if it is wanted.

    Messages may be long: they go to Python a hundred at a time, not ten thousand as batches of Arrow do, and don't come back.
    """
    kind = f"{PARSED}, body string" if body else PARSED
    read = F.udf(functools.partial(_parsed, body=body), kind, useArrow=False).asNondeterministic()  # so that it is never worked out twice
    return messages.select("msg_id", "raw", read("raw").alias("parsed")).select("msg_id", "raw", "parsed.*")


def classify(parsed: DataFrame) -> DataFrame:
    """msg_id, kind (bounce, ooo or null), the address it is about, and its date."""
    bounce = F.col("subject").rlike(vocab.NDR_SUBJECT) | F.col("sender").rlike(vocab.NDR_FROM)
    away = F.col("auto") & F.col("subject").rlike(vocab.AWAY_SUBJECT)
    kind = F.when(bounce, "bounce").when(away, "ooo")
    address = F.when(bounce, F.regexp_extract("raw", vocab.FAILED, 1)).when(away, F.regexp_extract("sender", vocab.ADDRESS, 0))
    return parsed.select("msg_id", kind.alias("kind"), F.nullif(F.lower(address), F.lit("")).alias("email"), F.when(kind.isNotNull(), F.try_to_date("sent_on")).alias("evdate"))


def person_name(name: Column) -> Column:
    """Two or three words that are no words of titles or companies."""
    return let(F.split(F.trim(name), r"\s+"), lambda words: F.size(words).between(2, 3) & ~F.exists(words, lambda w: F.lower(w).isin(vocab.NOT_NAMES)))


def name_of_local(local: Column) -> Column:
    return let(F.split(local, "[._]"), lambda parts: F.when((F.size(parts) == 2) & F.forall(parts, lambda p: p.rlike("^[A-Za-z]{2,}$")), F.initcap(F.array_join(parts, " "))))


def place_of(email: Column, lower: Column) -> Column:
    """An address's first place in a text in lower case; null if it isn't there."""
    return let(F.instr(lower, email), lambda at: F.when(at > 0, at))


def name_near(body: Column, at: Column) -> Column:
    """The name next before a place in a text, else the first one in its line."""
    start = F.greatest(at - 220, F.lit(1))
    near = F.regexp_extract_all(F.substring(body, start, at - start), F.lit(vocab.NAME_NEAR), F.lit(1))
    line = F.concat(F.substring_index(F.substring(body, F.lit(1), at - 1), "\n", -1), F.substring_index(F.substring(body, at, F.length(body)), "\n", 1))
    return let(near, lambda names: F.when(F.size(names) > 0, F.element_at(names, -1)).otherwise(F.nullif(F.regexp_extract(line, vocab.NAME_NEAR, 1), F.lit(""))))


def window_of(body: Column, at: Column) -> Column:
    """The text around a place in which a role may stand."""
    start = F.greatest(at - 220, F.lit(1))
    return F.substring(body, start, at + 60 - start)


def roles_in(window: Column) -> Column:
    """The first title that a text contains, as it is listed (role_raw), and what it stands for (role)."""
    found = let(F.lower(F.trim(window)), lambda text: first_contained(text, {k: k for k in vocab.ROLES}))
    role = lambda raw: functools.reduce(lambda c, kv: c.when(raw == kv[0], F.lit(kv[1])), vocab.ROLES.items(), F.when(raw.isNull(), F.lit(None).cast("string")))
    return let(found, lambda raw: F.struct(raw.alias("role_raw"), role(raw).alias("role")))


def harvest_replies(parsed: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """People named in replies: address, name and role nearby. The sender is never one; the first capture of an address
    counts unless it has no role and a later one has."""
    text = F.concat_ws(" ", F.coalesce("reply_to", F.lit("")), "body")
    if "sender_address" not in parsed.columns:
        parsed = parsed.withColumn("sender_address", F.lower(F.regexp_extract("sender", vocab.ADDRESS, 0)))
    hits = parsed.select("msg_id", "sender_address", "body", text.alias("text")).select("msg_id", "sender_address", "body", F.posexplode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"), F.lit(0))).alias("pos", "raw"))
    rows = hits.withColumn("email", clean_address(F.col("raw"))).filter("email is not null").filter(~F.col("email").eqNullSafe(F.col("sender_address")))
    own, person = name_of_local(local_part(F.col("email"))), lambda name: F.when(person_name(name), name)
    told = lambda at: F.struct(F.coalesce(let(own, person), let(name_near(F.col("body"), at), person)).alias("full_name"), let(window_of(F.col("body"), at), roles_in).alias("in"))
    said = let(place_of(F.col("email"), F.lower("body")), told)
    rows = rows.withColumn("said", said)
    rows = rows.withColumns({"role_raw": F.col("said.in.role_raw"), "role": F.col("said.in.role"), "full_name": F.col("said.full_name"), "reason": reject_reason(local_part(F.col("email")), domain_part(F.col("email")), self_domains)})
    first = Window.partitionBy("email").orderBy(F.col("role").isNull(), "msg_id", "pos")
    return rows.withColumn("n", F.row_number().over(first)).filter("n = 1").select("email", "full_name", "role_raw", "role", "reason", "msg_id")


def release_date(fields: list[Column]) -> Column:
    """The first field that is a date in one of two forms."""
    return F.coalesce(*[F.coalesce(F.try_to_date(f, "yyyy-MM-dd"), F.try_to_date(f, "dd/MM/yyyy")) for f in fields])


def release_date_of(payload: Column) -> Column:
    """The date of a release given as JSON: the first of the fields in which one may stand that is a date or a time."""
    return release_date([F.left(F.get_json_object(payload, f"$.{f}"), F.lit(10)) for f in vocab.DATE_FIELDS])


def release_name(name: Column) -> Column:
    """Two or three words, none of a role, label or company."""
    word = lambda w: F.btrim(F.lower(w), F.lit(".,'")).isin(vocab.RELEASE_NOT_NAMES)
    return let(F.split(F.trim(name), r"\s+"), lambda words: F.size(words).between(2, 3) & ~F.exists(words, word))


def appointed_role(raw: Column) -> Column:
    """A captured role without the clauses behind it; null over 8 words. ' of Acme' goes too, but not of 'Head of Design' or 'Director of Sales'."""
    tidy = lambda c: F.btrim(c, F.lit(" .,-"))
    role = tidy(F.regexp_replace(raw, r"(?U)\s+", " "))
    role = F.regexp_replace(role, r"\s+(?:at|for|of the|with)\s+[A-Z].*", "")
    role = F.regexp_replace(role, rf"(?<!\b(?:[Hh]ead|[Cc]hief))\s+of\s+(?!(?i:{'|'.join(vocab.TITLE_WORDS)})\b)[A-Z].*", "")
    role = tidy(F.regexp_replace(role, r"(?i)\s+(?:from|effective|commencing|starting|beginning)\b.*", ""))
    return let(role, lambda own: F.when((own != "") & (F.size(F.split(own, " +")) <= 8), own))


def appointees(title: Column, body: Column) -> Column:
    """Names and roles of all people said to be appointed; a gate on the whole of title and text comes first.

    Each pattern's every match in title and text counts, a name once, with the first role that it has. A pattern is only
    tried on texts that hold a word without which it can't match. Texts may be long: no step is quadratic in their length.
    """
    none = F.array().cast("array<struct<name:string,role:string>>")

    def matches(text: Column, pattern: str, word: str) -> Column:
        if pattern.startswith("(?U)([A-Z]"):  # a long word isn't read again from each of its capitals: a name has the first, or the first behind the last match
            pattern = r"(?U)(?:(?<![a-zA-Z'\-])|\G)[a-z'\-]*+" + pattern.removeprefix("(?U)")
        every = F.zip_with(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (1, 2)], lambda name, role: F.struct(name.alias("name"), role.alias("role")))
        return F.when(F.contains(text, F.lit(word)), every).otherwise(none)

    def told(text: Column) -> Column:
        every = F.concat(*[matches(text, p, w) for p, w in zip(vocab.APPOINTED, vocab.APPOINTED_WORDS, strict=True)])
        row = lambda m, at: let(appointed_role(m["role"]), lambda role: F.struct(m["name"].alias("name"), role.isNull().alias("bare"), at.alias("at"), role.alias("role")))
        found = F.sort_array(F.transform(F.filter(every, lambda m: release_name(m["name"])), row))
        first = lambda all_: F.filter(all_, lambda m, k: (k == 0) | (m["name"] != F.get(all_, k - 1)["name"]))
        return F.transform(let(found, first), lambda m: F.struct(m["name"].alias("name"), m["role"].alias("role")))

    whole = F.concat(F.coalesce(title, F.lit("")), F.lit(". "), body)
    return F.when((body != "") & whole.rlike(vocab.APPOINTING), let(whole, told)).otherwise(none)


def appointments(releases: DataFrame) -> DataFrame:
    """release_id, name and role of appointees() in title and body of each release."""
    return releases.select("release_id", F.inline(appointees(F.col("title"), F.col("body"))))


def in_house(client: Column, domain: Column, agencies: list[str] = vocab.HOUSE_AGENCIES) -> Column:
    """Whether a domain is the client's own: one of its labels is a telling word of the client's name, or one of both, the
    word of four letters or more, is part of the other. An agency's never is."""
    words = F.transform(F.split(F.lower(client), r"\s+"), lambda w: F.regexp_replace(w, "[^a-z0-9]", ""))
    words = F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(vocab.CLIENT_STOPS))
    labels = F.array_except(F.split(F.lower(domain), r"\."), F.array(*map(F.lit, vocab.DOMAIN_ENDS)))
    meets = lambda w, x: (w == x) | ((F.length(w) >= 4) & (F.contains(x, w) | ((x != "") & F.contains(w, x))))
    own = lambda all_: F.exists(words, lambda w: F.exists(all_, lambda x: meets(w, x)))
    return F.coalesce(let(labels, lambda all_: ~F.arrays_overlap(all_, F.array(*map(F.lit, agencies))) & own(all_)), F.lit(False))


def made_local(name: Column, pattern: Column) -> Column:
    """The local part that a pattern gives a name; null if a part of the name has no letters."""
    parts = lambda whole: F.struct(*[slug(c).alias(n) for c, n in zip(split_first_last(whole), ("f", "l"), strict=True)])
    made = lambda p: F.when((p["f"] != "") & (p["l"] != ""), generated_local(pattern, p["f"], p["l"]))
    return let(let(name, parts), made)


def extrapolate(appointees: DataFrame, formats: DataFrame) -> DataFrame:
    """Addresses for appointees of a release from its in-house formats, where a domain has exactly one.

    The least and the greatest format of a domain are all that is kept of its formats: they are equal if there is one.
    """
    one = formats.groupBy("release_id", "domain").agg(F.min("pattern").alias("pattern"), F.max("pattern").alias("other"))
    one = one.filter(F.col("pattern") == F.col("other")).drop("other")
    rows = appointees.join(one, "release_id").withColumn("email", F.concat(made_local(F.col("name"), F.col("pattern")), F.lit("@"), "domain"))
    return rows.filter("email is not null").withColumn("confidence", F.lit("inferred"))
