"""People of an organisation's page, put together from all that tells of them: structured data, cards, addresses.

A page's addresses are ranked sources of its address pattern. All ranks are looked at in one grouped pass, each by itself,
and the first one that shows a pattern decides. What nobody got of the addresses becomes people of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import domain_part, generated_local, known_prefixes, local_part, role_normalised, site_domain, split_first_rest
from ..sources.tables import kept
from . import html
from .people import infer_patterns, orphan_names

#: Where a pattern may come from, in this order: addresses at the site's own domain, all of the page but free mail and with
#: the locator's, and those of structured data.
SITE, BUSINESS, STRUCTURED = 1, 2, 3


def _api(dealers: DataFrame) -> Column:
    return F.nullif(F.lower(F.trim("api_email")), F.lit(""))


def ranked_addresses(pages: DataFrame, dealers: DataFrame) -> DataFrame:
    """id, rank, seq and email of all addresses that may tell a pattern. Pages are read once."""
    parsed = html.parse_pages(pages, "id", "url", ("text", "mailtos"))
    page = html.emails_of_pages(parsed, "id")
    page = page.filter((html.email_kind(F.col("email")) == "person") & ~domain_part(F.col("email")).isin(vocab.FREEMAIL))
    page = page.withColumn("seq", F.row_number().over(Window.partitionBy("id").orderBy("email")))  # of one page
    page = kept(page, "page-addresses")
    parsed = html.parse_pages(pages, "id", "url", ("people",))
    site = dealers.select("id", site_domain(F.col("website_url")).alias("site"))
    own = page.join(site, "id").filter(F.col("site").isNull() | (domain_part(F.col("email")) == F.col("site")))
    api = dealers.select("id", _api(dealers).alias("email")).filter(F.contains("email", F.lit("@")))
    api = api.filter(~domain_part(F.col("email")).isin(vocab.FREEMAIL)).join(page.select("id", "email"), ["id", "email"], "left_anti")
    told = parsed.select("id", F.posexplode("people").alias("seq", "p")).select("id", "seq", F.lower("p.email").alias("email")).filter(F.contains("email", F.lit("@")))
    row = lambda df, rank, seq: df.select("id", F.lit(rank).alias("rank"), seq.cast("long").alias("seq"), "email")
    return row(own, SITE, F.col("seq")).union(row(page, BUSINESS, F.col("seq"))).union(row(api, BUSINESS, F.lit(2**40))).union(row(told, STRUCTURED, F.col("seq")))


def guesses(addresses: DataFrame, dealers: DataFrame) -> DataFrame:
    """id, pattern (null if no source shows one), and the form and domain by which addresses are guessed, if any are:
    first.last at the locator's domain where there is no pattern."""
    found = infer_patterns(addresses.select(F.struct("id", "rank").alias("key"), "seq", "email"), "key", business_only=False)
    best = found.filter("pattern is not null").groupBy(F.col("key.id").alias("id")).agg(F.min_by(F.struct("pattern", "domain"), "key.rank").alias("best"))
    api = F.when(F.contains(_api(dealers), F.lit("@")), domain_part(_api(dealers)))
    rows = dealers.select("id", api.alias("api")).join(best, "id", "left")
    fallback = F.when(F.col("api").isNotNull(), F.struct(F.lit("first.last").alias("pattern"), F.col("api").alias("domain")))
    chosen = F.coalesce("best", fallback)
    return rows.select("id", F.col("best.pattern").alias("pattern"), chosen["pattern"].alias("form"), chosen["domain"].alias("domain"))


def named_people(pages: DataFrame) -> DataFrame:
    """id, seq, full_name, role_raw, email and where a person is from (jsonld, else page); page people whose name
    structured data has are left out."""
    parsed = kept(html.parse_pages(pages, "id", "url", ("content", "people", "headings")), "page-people")
    first = parsed.select("id", F.posexplode("people").alias("seq", "p")).select("id", "seq", F.col("p.name").alias("full_name"), F.nullif(F.trim("p.role"), F.lit("")).alias("role_raw"), F.col("p.email").alias("email"), F.lit("jsonld").alias("found_in"))
    rest = html.card_people(parsed, "id").select("id", "seq", F.col("name").alias("full_name"), F.col("role").alias("role_raw"), F.lit(None).cast("string").alias("email"), F.lit("page").alias("found_in"))
    known = first.select("id", F.lower("full_name").alias("name")).distinct()
    rest = rest.withColumn("name", F.lower("full_name")).join(known, ["id", "name"], "left_anti").drop("name")
    both = first.unionByName(rest)
    one, other = split_first_rest(F.col("full_name"))
    return both.withColumns({"first_name": one, "last_name": other})


def fuse_people(pages: DataFrame, dealers: DataFrame) -> DataFrame:
    """Contacts of organisations from their pages (id, url, html) and listings (id, website_url, api_email).

    Gives id, full_name, first_name, last_name, role_raw, role_normalised, email, email_domain, email_pattern, confidence
    and found_in (jsonld, page or address). A person has the address structured data gives, else the organisation's that a
    prefix of the name makes (both direct), else the one guessed (inferred); without any, none (direct).
    """
    addresses, people = kept(ranked_addresses(pages, dealers), "ranked-addresses"), kept(named_people(pages), "named-people")
    usable = addresses.filter(F.col("rank") > SITE)
    # of addresses with one local part the last one counts: structured data's, else the locator's, else the page's
    known = usable.groupBy("id", F.lower(local_part(F.col("email"))).alias("local")).agg(F.max_by("email", F.struct("rank", "seq")).alias("known"))
    guess = guesses(addresses, dealers)

    rows = people.join(guess, "id", "left")
    whole = F.coalesce(F.length("first_name") > 0, F.lit(False)) & F.coalesce(F.length("last_name") > 0, F.lit(False))
    may_match = F.when(F.col("found_in") == "jsonld", F.col("form").isNotNull() & whole).otherwise(F.length("first_name") > 0) & F.col("email").isNull()
    tried = rows.filter(may_match).select("id", "found_in", "seq", F.posexplode(known_prefixes(F.col("first_name"), F.col("last_name"))).alias("turn", "local"))
    hits = tried.join(known, ["id", "local"]).groupBy("id", "found_in", "seq").agg(F.min_by("known", "turn").alias("match"))
    rows = rows.join(hits, ["id", "found_in", "seq"], "left")
    made = F.concat(generated_local(F.col("form"), F.col("first_name"), F.col("last_name")), F.lit("@"), "domain")
    rows = rows.withColumn("guess", F.when(whole & F.coalesce("email", "match").isNull(), made))
    email = F.coalesce("email", "match", "guess")
    # structured people are looked at again once the pattern is known, and then carry the form their address was made by
    pattern = F.when(F.col("found_in") == "page", F.col("pattern")).when(F.col("guess").isNotNull(), F.col("form"))
    rows = rows.select("id", "full_name", "first_name", "last_name", "role_raw", email.alias("email"), pattern.alias("email_pattern"), F.when(F.col("guess").isNotNull(), "inferred").otherwise("direct").alias("confidence"), "found_in")

    # addresses nobody got, as sets of an organisation: those of its page, listing and structured data, without all given ones
    of_rank = lambda keep: F.coalesce(F.collect_set(F.when(keep, F.col("email"))), F.array())
    sets = usable.groupBy("id").agg(of_rank(F.col("rank") == BUSINESS).alias("business"), of_rank(F.col("rank") == STRUCTURED).alias("structured"))
    given = rows.groupBy("id").agg(F.collect_set("email").alias("given"))
    left = sets.join(given, "id", "left").select("id", F.explode(F.array_except(F.array_union("business", "structured"), F.coalesce("given", F.array().cast("array<string>")))).alias("email"))
    orphans = orphan_names(left).select("id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "first_name", "last_name", F.lit(None).cast("string").alias("role_raw"), "email", F.lit(None).cast("string").alias("email_pattern"), F.lit("direct").alias("confidence"), F.lit("address").alias("found_in"))
    return rows.unionByName(orphans).withColumns({"role_normalised": role_normalised(F.col("role_raw")), "email_domain": F.when(F.contains("email", F.lit("@")), domain_part(F.col("email")))})
