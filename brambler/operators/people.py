"""Address patterns, known addresses, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import detected_format, domain_part, generated_local, is_gateway, known_prefixes, local_part, mx_provider, rcpt_verdict, split_first_last


def infer_patterns(emails: DataFrame, key: str, business_only: bool = True) -> DataFrame:
    """key, pattern and domain from known addresses (key, email, seq): the most common domain (first seen first), then
    the form that most of its local parts have. Free mail doesn't count, unless all addresses are to."""
    rows = emails.withColumn("domain", domain_part(F.col("email"))).filter("domain <> ''")
    if business_only:
        rows = rows.filter(~F.col("domain").isin(vocab.FREEMAIL))
    counts = rows.groupBy(key, "domain").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).filter("rank = 1").select(key, "domain")
    own = local_part(F.col("email"))
    plain = own.rlike("^[a-z]+$") & (F.length(own) > 2)
    stats = rows.join(top, [key, "domain"]).groupBy(key, "domain").agg(
        F.count("*").alias("n"), F.count_if(F.contains(own, F.lit("."))).alias("dots"), F.count_if(F.contains(own, F.lit("_"))).alias("lines"),
        F.count_if(plain).alias("plain"), F.avg(F.when(plain, F.length(own))).alias("mean"),
    )
    pattern = F.when(F.col("dots") * 2 > F.col("n"), "first.last").when(F.col("lines") * 2 > F.col("n"), "first_last").when(F.col("plain") >= 2, F.when(F.col("mean") > 5, "flast").otherwise("first"))
    return stats.select(key, "domain", pattern.alias("pattern"))


def generate_addresses(people: DataFrame) -> DataFrame:
    """people (first_name, last_name, pattern, domain) with the address that the pattern gives, marked as inferred."""
    local = generated_local(F.col("pattern"), F.col("first_name"), F.col("last_name"))
    return people.withColumn("email", F.concat(local, F.lit("@"), "domain")).withColumn("confidence", F.when(F.col("email").isNotNull(), "inferred"))


def match_known(people: DataFrame, emails: DataFrame, key: str) -> DataFrame:
    """For each person (id, key, first_name, last_name) the known address of the same key that fits its name first."""
    tried = people.select("id", key, F.posexplode(known_prefixes(F.col("first_name"), F.col("last_name"))).alias("turn", "local"))
    known = emails.select(key, F.lower(local_part(F.col("email"))).alias("local"), "email")
    return tried.join(known, [key, "local"]).groupBy("id").agg(F.min_by("email", F.struct("turn", "email")).alias("email"))


def orphan_addresses(emails: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Addresses nobody was matched to whose local part is two words become people."""
    return orphan_names(emails.join(matched.select(key, "email"), [key, "email"], "left_anti")).select(key, "email", "first_name", "last_name")


def orphan_names(rest: DataFrame) -> DataFrame:
    """Rows whose address is two words of letters, with these as a name."""
    parts = F.split(local_part(F.col("email")), F.when(F.contains(local_part(F.col("email")), F.lit(".")), r"\.").otherwise("_"))
    ok = (F.size(parts) == 2) & F.forall(parts, lambda p: p.rlike("^[A-Za-z]{2,}$"))
    return rest.filter(ok).withColumns({"first_name": F.initcap(F.get(parts, F.lit(0))), "last_name": F.initcap(F.get(parts, F.lit(1)))})


def domain_formats(senders: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """domain, its most common form of addresses, how often that was seen, all senders, and the first sample."""
    first, last = split_first_last(F.col("display_name"))
    rows = senders.withColumns({"domain": F.lower(domain_part(F.col("address"))), "form": detected_format(first, last, local_part(F.col("address")))})
    rows = rows.filter(~F.col("domain").isin([*vocab.FREEMAIL, *self_domains]))
    seen = rows.groupBy("domain").agg(F.count("*").alias("sender_count"))
    forms = rows.filter("form is not null").groupBy("domain", "form").agg(F.count("*").alias("pattern_count"), F.min(F.struct("seq", "address")).alias("sample"))
    top = forms.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("pattern_count"), "sample.seq"))).filter("rank = 1")
    return top.join(seen, "domain").select("domain", F.col("form").alias("pattern"), F.col("sample.address").alias("sample_email"), "sender_count", "pattern_count")


def published_over_derived(published: DataFrame, derived: DataFrame) -> DataFrame:
    return published.withColumn("confidence", F.lit("direct")).unionByName(derived.join(published.select("email"), "email", "left_anti").withColumn("confidence", F.lit("inferred")))


def mx_hosts(records: DataFrame) -> DataFrame:
    """domain and its exchangers by preference."""
    ordered = F.array_sort(F.collect_list(F.struct("preference", "host")))
    return records.filter("host is not null").groupBy("domain").agg(F.transform(ordered, lambda x: x["host"]).alias("hosts"))


def lookup_status(records: DataFrame) -> DataFrame:
    """domain and what its lookup came to: empty with an exchanger, else nxdomain, no_mx or dns_error with its class.

    records: domain, preference, host and error (the class of an answer that is none).
    """
    error = F.max("error")
    status = F.when(F.count("host") > 0, "").when(error == "NXDOMAIN", "nxdomain").when(error.isNull() | error.isin("NoAnswer", "NoNameservers"), "no_mx").otherwise(F.concat(F.lit("dns_error:"), error))
    return records.groupBy("domain").agg(status.alias("lookup"))


def verify_by_dns(contacts: DataFrame, records: DataFrame, self_domains: tuple[str, ...] = ()) -> DataFrame:
    """id with status, provider and exchanger: syntax, then a dead domain, a shared inbox, a gateway, else unknown."""
    hosts = mx_hosts(records)
    email = F.lower(F.trim(F.coalesce("email", F.lit(""))))
    domain = F.lower(F.trim(F.coalesce("email_domain", F.substring_index(email, "@", -1))))
    rows = contacts.filter("email is not null").select("id", email.alias("email"), domain.alias("domain")).join(hosts, "domain", "left")
    provider = F.when(F.col("hosts").isNotNull(), mx_provider(F.col("hosts"))).otherwise("dead")
    bad = ~F.col("email").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$") | F.col("domain").isin(list(self_domains))
    status = F.when(bad, "bad_syntax").when(F.col("hosts").isNull(), "dead_domain").when(local_part(F.col("email")).isin(vocab.VERIFY_ROLES), "role").when(is_gateway(provider), "unknown_gateway").otherwise("unknown")
    return rows.select("id", status.alias("verify_status"), F.when(~bad, provider).alias("verify_provider"), F.when(~bad, F.get("hosts", F.lit(0))).alias("verify_mx"))


def verify_by_probe(contacts: DataFrame, results: DataFrame) -> DataFrame:
    """id with the verdict of given reply codes; the provider found by DNS stays."""
    rows = contacts.filter("email is not null and not suppressed").join(results, F.col("email") == F.col("address"))
    verdict = rcpt_verdict(F.col("catchall_code"), F.col("code"))
    return rows.select("id", verdict.alias("verify_status"), (verdict == "catchall").alias("verify_catchall"))


def probe_groups(verified: DataFrame) -> DataFrame:
    """Addresses to probe, one row with all of them for each exchanger and domain. Superseded by probe_order(), whose rows stay small."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "email")))
    return verified.groupBy("email_domain", "verify_mx").agg(F.transform(pairs, lambda x: x["id"]).alias("ids"), F.transform(pairs, lambda x: x["email"]).alias("emails"))


def probe_order(verified: DataFrame) -> DataFrame:
    """Addresses to probe, a row each, with their turn at their exchanger and domain (the first may be probed at once)."""
    turn = F.row_number().over(Window.partitionBy("email_domain", "verify_mx").orderBy("id"))
    return verified.select("email_domain", "verify_mx", turn.alias("turn"), "id", "email")


def reject_reason(local: Column, domain: Column, self_domains: tuple[str, ...] = ()) -> Column:
    """Why an address of a mail isn't kept: one's own, free mail, a shared inbox, a token; null if it is kept."""
    opaque = local.rlike("(?i)^[0-9a-f]{16,}$") | local.rlike("[0-9]{6,}")
    return F.when(domain.isin(list(self_domains)), "self").when(domain.isin(vocab.FREEMAIL), "freemail").when(local.isin(vocab.MAIL_ROLES), "role").when(opaque, "opaque")


def press_reject_reason(local: Column, domain: Column, self_domains: tuple[str, ...] = ()) -> Column:
    """As reject_reason() for addresses in releases: shared inboxes of press offices too, also by the first token or as a
    prefix, and names of over 40 characters."""
    roles = [*vocab.MAIL_ROLES, *vocab.PRESS_ROLES]
    role = local.isin(roles) | F.get(F.split(local, r"[._\-]"), F.lit(0)).isin(roles) | local.rlike("^(noreply|no-reply|mailer)")
    opaque = local.rlike("(?i)^[0-9a-f]{16,}$") | local.rlike("[0-9]{6,}") | (F.length(local) > 40)
    return F.when(domain.isin(list(self_domains)), "self").when(domain.isin(vocab.FREEMAIL), "freemail").when(role, "role").when(opaque, "opaque")


def fill_addresses(people: DataFrame, emails: DataFrame, patterns: DataFrame, key: str) -> DataFrame:
    """id, email and confidence of people: an address they already have, else one of the organisation's that a prefix of
    their name makes (direct), else what its pattern gives (inferred). patterns: key, pattern and domain."""
    lacking = people.filter("email is null")
    direct = match_known(lacking, emails, key).withColumnRenamed("email", "match")
    guess = generate_addresses(lacking.join(patterns, key)).select("id", F.col("email").alias("guess"))
    rows = people.select("id", "email").join(direct, "id", "left").join(guess, "id", "left")
    email = F.coalesce("email", "match", "guess")
    return rows.select("id", email.alias("email"), F.when(F.coalesce("email", "match").isNotNull(), "direct").when(email.isNotNull(), "inferred").alias("confidence"))
