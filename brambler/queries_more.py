"""Further queries: counts of commands, orders and samples, fills of addresses, pages and releases with people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bindings import AS_OF
from .functions import scalars as S
from .functions import vocab
from .operators import fusion, html, mail, people, read, release, state
from .queries import _RECENT_BATCH, _SITE_SQL, _patterns_sql, among, query
from .sources import schemas, tables

# ---- counts


@query("SELECT source, count(*) AS n FROM contacts WHERE ruled_out_stage = 'wp-member' GROUP BY source")
def members_by_source(contacts):
    return read.members_by_source(contacts)


@query("SELECT CASE WHEN verify_status IS NULL THEN 'none' ELSE verify_status END AS status, count(*) AS n, sum(count(*)) OVER () AS total FROM contacts WHERE suppressed GROUP BY 1")
def suppressed_by_status(contacts):
    return read.suppressed_by_status(contacts)


@query("SELECT count(*) FILTER (email IS NOT NULL) AS emailable, count(*) AS n, coalesce(proximity_tier, 'none') AS tier FROM contacts WHERE disposition = 'in_play' GROUP BY 3")
def tier_emailable(contacts):
    return read.tier_emailable(contacts)


@query("SELECT disposition, count(*) AS n, count(*) FILTER (company IS NOT NULL AND company <> '') AS with_company FROM contacts GROUP BY disposition")
def disposition_companies(contacts):
    return read.disposition_companies(contacts)


_ROLE_LOCAL = "(sales|parts|service|enquir|admin|info|contact|dealer|princip|manage|management|team|depart|dept|form|recept|account|warranty|finance|fleet|used|general|office|mail|marketing|career|jobs|workshop|booking|aftersales|make|anenquiry|customer|business|interpreter|reservation|leads?|bdc)"


@query(
    f"""WITH g AS (SELECT lower(split_part(email, '@', 1)) AS lp, count(DISTINCT email_domain) AS domains, count(DISTINCT lower(full_name)) AS names, count(*) AS people FROM contacts
      WHERE email IS NOT NULL AND NOT suppressed AND regexp_matches(split_part(email, '@', 1), '^[a-z]+[._][a-z]+$') AND NOT regexp_matches(lower(split_part(email, '@', 1)), '{_ROLE_LOCAL}')
      AND regexp_matches(full_name, '^[A-Za-z]+ +[A-Za-z]') GROUP BY 1)
    SELECT lp, domains, names, people, people - 1 AS redundant FROM g WHERE domains BETWEEN 2 AND 4 AND names = 1"""
)
def duplicate_groups(contacts):
    return state.duplicate_groups(contacts)


@query(f"SELECT CASE WHEN {among('d', vocab.FREEMAIL)} THEN 'freemail' WHEN {among('l', vocab.MAIL_ROLES)} THEN 'role' WHEN regexp_matches(l, '[0-9]{{6,}}') THEN 'opaque' ELSE 'kept' END AS reason, count(*) AS n FROM (SELECT split_part(email, '@', 1) AS l, split_part(email, '@', 2) AS d FROM contacts WHERE email IS NOT NULL) AS x GROUP BY 1")
def capture_counts(contacts):
    """How many captured addresses each reason leaves out."""
    reason = people.reject_reason(S.local_part(F.col("email")), S.domain_part(F.col("email")))
    return contacts.filter("email is not null").groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


# ---- selections, orders and samples


@query("SELECT id, name, website_url, row_number() OVER (ORDER BY id) AS turn FROM dealerships WHERE scrape_state = 'discovered' AND website_url IS NOT NULL AND brand_slug = 'brand_4' ORDER BY id LIMIT 50")
def stage_selection(dealerships):
    return read.ranked(read.stage_selection(dealerships, "discovered", "brand_4", 50), "turn", F.col("id"))


@query("SELECT id, email, row_number() OVER (ORDER BY coalesce(brand_slug, ''), coalesce(dealership, ''), full_name, id) AS turn FROM (SELECT c.*, d.brand_slug, d.name AS dealership FROM contacts AS c LEFT JOIN dealerships AS d ON c.dealership_id = d.id WHERE c.email IS NOT NULL) AS x ORDER BY turn LIMIT 1000")
def export_order(contacts, dealerships):
    """The first page of an export, in its order."""
    rows = read.with_dealership(contacts.filter("email is not null"), dealerships)
    return read.ranked(rows.orderBy(*read.export_order()).limit(1000), "turn", *read.export_order()).select("id", "email", "turn")


_RECENT = f"source = 'newspress' AND NOT suppressed AND disposition = 'in_play' AND source_date >= {AS_OF} - INTERVAL 36 MONTH"


@query(f"SELECT id, email, row_number() OVER (ORDER BY source_date DESC NULLS LAST, email, id) AS turn FROM contacts WHERE {_RECENT} ORDER BY turn LIMIT 15")
def recent_sample(contacts):
    """A sample of the latest people of releases."""
    rows = contacts.filter(f"source = 'newspress' AND NOT suppressed AND disposition = 'in_play' AND source_date >= add_months({AS_OF}, -36)")
    return read.ranked(read.sample(rows, 15, *read.recent_order()), "turn", *read.recent_order()).select("id", "email", "turn")


@query("SELECT (SELECT count(*) FROM contacts WHERE NOT suppressed) AS total, id FROM contacts WHERE NOT suppressed ORDER BY source_date DESC NULLS LAST, id DESC LIMIT 25 OFFSET 50")
def page_with_total(contacts):
    return read.page_with_total(contacts.filter("not suppressed"), "newest", 25, 50)


@query(
    """SELECT c.id, c.email, mail_id, sent_on FROM contacts AS c JOIN archive_accounts ON contains(lower(to_header), c.email)
    WHERE c.email IS NOT NULL AND lower(account_email) IN (SELECT lower(trim(email)) FROM sender_accounts) AND is_outgoing AND (body ILIKE '%the marker%' OR html_body ILIKE '%the marker%')"""
)
def preflight_by_account(contacts, archive_accounts, sender_accounts):
    """Whoever an account has written to: their address is part of another's in the header."""
    return read.preflight_matches(contacts, archive_accounts, "the marker", sender_accounts)


@query(
    """WITH t AS (SELECT count(*) FILTER (event = 'sent') AS sent, count(*) FILTER (event = 'bounced') AS bounced, count(*) FILTER (event = 'complained') AS complained FROM send_events)
    SELECT sent, bounced, complained, round(bounced / sent, 5) AS bounce_rate, round(complained / sent, 5) AS complaint_rate, CASE WHEN sent = 0 THEN 'no-sends' WHEN complained / sent >= 0.0005 OR bounced / sent >= 0.03 THEN 'stop' WHEN bounced / sent >= 0.02 THEN 'warn' ELSE 'ok' END AS status FROM t"""
)
def sends_health(send_events):
    return read.sends_health(send_events)


# ---- people and addresses


@query("SELECT email, nullif(split_part(nm, ' ', 1), '') AS first_name, CASE WHEN contains(nm, ' ') THEN nullif(substr(nm, strpos(nm, ' ') + 1), '') END AS last_name FROM (SELECT lower(email) AS email, max_by(trim(name), name) AS nm FROM subscriber_states WHERE state = 'active' GROUP BY 1) AS x")
def active_reload(subscriber_states):
    """What the table of active subscribers holds after a reload."""
    return state.active_subscribers(subscriber_states).select("email", "first_name", "last_name")


@query(
    """SELECT email_domain AS key, email, upper(substr(f, 1, 1)) || substr(f, 2) AS first_name, upper(substr(l, 1, 1)) || substr(l, 2) AS last_name FROM (
      SELECT email_domain, email, split_part(lp, '.', 1) AS f, split_part(lp, '.', 2) AS l FROM (SELECT DISTINCT email_domain, email, split_part(email, '@', 1) AS lp FROM contacts WHERE email IS NOT NULL AND confidence = 'direct') AS x
      WHERE regexp_matches(lp, '^[a-z]{2,}[.][a-z]{2,}$')) AS y"""
)
def orphan_people(contacts):
    """People made of addresses that nobody with a name of the same organisation has."""
    emails = contacts.filter("email is not null and confidence = 'direct'").select(F.col("email_domain").alias("key"), "email").distinct()
    return people.orphan_addresses(emails, emails.limit(0), "key")


@query(
    f"""WITH p AS ({_patterns_sql("SELECT dealership_id AS grp, email, id AS seq FROM contacts WHERE email IS NOT NULL AND dealership_id IS NOT NULL")}),
    known AS (SELECT DISTINCT dealership_id, split_part(email, '@', 1) AS lp, email FROM contacts WHERE email IS NOT NULL AND dealership_id IS NOT NULL),
    tried AS (SELECT id, dealership_id, unnest([f || '.' || l, substr(f, 1, 1) || l, f, f || substr(l, 1, 1), l || '.' || f, l || substr(f, 1, 1), f || '_' || l, f || l]) AS lp, unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS turn
      FROM (SELECT id, dealership_id, lower(first_name) AS f, lower(last_name) AS l FROM contacts WHERE email IS NULL AND dealership_id IS NOT NULL) AS x),
    hit AS (SELECT id, min_by(email, (turn, email)) AS match FROM tried JOIN known USING (dealership_id, lp) GROUP BY id),
    made AS (SELECT id, CASE pattern WHEN 'first.last' THEN first_name || '.' || last_name WHEN 'first_last' THEN first_name || '_' || last_name WHEN 'flast' THEN substr(first_name, 1, 1) || last_name WHEN 'first' THEN first_name END || '@' || domain AS guess
      FROM contacts JOIN p ON grp = dealership_id WHERE email IS NULL)
    SELECT c.id, coalesce(c.email, match, guess) AS email, CASE WHEN coalesce(c.email, match) IS NOT NULL THEN 'direct' WHEN guess IS NOT NULL THEN 'inferred' END AS confidence
    FROM contacts AS c LEFT JOIN hit USING (id) LEFT JOIN made USING (id) WHERE c.dealership_id IS NOT NULL"""
)
def filled_addresses(contacts):
    """Contacts of organisations with the address they have, match or may be guessed."""
    rows = contacts.filter("dealership_id is not null")
    known = rows.filter("email is not null")
    patterns = people.infer_patterns(known.select("dealership_id", "email", F.col("id").alias("seq")), "dealership_id")
    return people.fill_addresses(rows.select("id", "dealership_id", "first_name", "last_name", "email"), known.select("dealership_id", "email").distinct(), patterns, "dealership_id")


_KNOWN = f"SELECT c.id AS seq, c.email, c.dealership_id, lower(c.email_domain) AS dom, site FROM contacts AS c JOIN (SELECT id AS d_id, {_SITE_SQL} AS site FROM dealerships) AS d ON d_id = c.dealership_id WHERE c.email IS NOT NULL"


@query(
    f"WITH one AS ({_patterns_sql(f'SELECT dealership_id AS grp, email, seq FROM ({_KNOWN}) AS k')}), two AS ({_patterns_sql(f'SELECT site AS grp, email, seq FROM ({_KNOWN}) AS k WHERE site IS NOT NULL')}), three AS ({_patterns_sql(f'SELECT dom AS grp, email, seq FROM ({_KNOWN}) AS k')}), "
    f"p AS (SELECT c.id, lower(first_name) AS f, lower(last_name) AS l, CASE WHEN one.grp IS NOT NULL THEN one.pattern WHEN two.grp IS NOT NULL THEN two.pattern ELSE three.pattern END AS pattern, CASE WHEN one.grp IS NOT NULL THEN one.domain WHEN two.grp IS NOT NULL THEN two.domain ELSE three.domain END AS domain FROM contacts AS c JOIN (SELECT id AS d_id, {_SITE_SQL} AS site FROM dealerships) AS d ON d_id = dealership_id "
    "LEFT JOIN one ON one.grp = dealership_id LEFT JOIN two ON two.grp = site LEFT JOIN three ON three.grp = site WHERE c.email IS NULL), "
    "m AS (SELECT id, pattern, CASE pattern WHEN 'first.last' THEN f || '.' || l WHEN 'first_last' THEN f || '_' || l WHEN 'flast' THEN substr(f, 1, 1) || l WHEN 'first' THEN f END || '@' || domain AS email FROM p) "
    "SELECT id, email, 'inferred' AS confidence, pattern FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY id) AS k FROM m WHERE email IS NOT NULL) AS x WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM contacts AS c WHERE c.email = x.email)"
)
def cross_dealer_pattern_levels(contacts, dealerships):
    return release.pattern_pass_levels(contacts, dealerships)


# ---- pages and releases

_CAP = "upper(substr({0}, 1, 1)) || substr({0}, 2)"


@query(
    f"""SELECT page_id, 'jsonld' AS found_in, f1 || ' ' || l1 AS name, 'Director' AS role, f1 || '@a.test' AS email FROM team_facts WHERE kind = 1
    UNION ALL SELECT page_id, 'page', {_CAP.format('f1')} || ' ' || {_CAP.format('l1')}, 'Sales Manager', NULL FROM team_facts WHERE kind = 0
    UNION ALL SELECT page_id, 'page', {_CAP.format('f2')} || ' Head', 'Service Advisor', NULL FROM team_facts WHERE kind = 1
    UNION ALL SELECT page_id, 'page', {_CAP.format('f2')} || ' ' || {_CAP.format('l2')}, 'Parts Manager', NULL FROM team_facts WHERE kind = 2"""
)
def team_page_people(team_pages):
    """People of pages by cards, by headings with a role, by text and from structured data."""
    parsed = html.parse_pages(team_pages, parts=("content", "people", "headings"))
    return html.fuse_people(html.jsonld_people(parsed), html.card_people(parsed))


@query("SELECT page_id, url || 'our-team/' AS href, 23 AS score, 1 AS rank FROM team_facts UNION ALL SELECT page_id, url || 'about', 2, 2 FROM team_facts")
def team_page_links(team_pages):
    return html.link_scores(html.parse_pages(team_pages, parts=("links",)))


_PATH_SCORE = "coalesce(" + ", ".join(f"CASE WHEN contains(href, '{p}') THEN CASE WHEN href LIKE '%{p}' OR href LIKE '%{p}/' THEN 15 ELSE 10 END END" for p in vocab.TEAM_PATHS) + ", 0)"


@query(
    f"""WITH links AS (SELECT page_id, 1 AS pos, lower(h1) AS href, lower(t1) AS text FROM link_facts UNION ALL SELECT page_id, 2, lower(h2), lower(t2) FROM link_facts UNION ALL SELECT page_id, 3, lower(h3), lower(t3) FROM link_facts),
    scored AS (SELECT page_id, pos, href, text, {_PATH_SCORE} + CASE WHEN regexp_matches(text, '{'|'.join(vocab.TEAM_WORDS)}') THEN 8 ELSE 0 END AS score FROM links),
    rated AS (SELECT page_id, pos, href, CASE WHEN regexp_matches(href, '^[^?#]*[.](pdf|jpg|png)([?#].*)?$') THEN 0 WHEN score = 0 AND contains(href, 'about') AND contains(text, 'about') THEN 2 ELSE score END AS score FROM scored)
    SELECT page_id, href, score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS INTEGER) AS rank FROM rated WHERE score > 0"""
)
def page_link_ranks(link_pages):
    """Links of pages by all paths and words that speak for people, at an end or within, and of files that are no pages."""
    return html.link_scores(html.parse_pages(link_pages, parts=("links",)))


@query("SELECT page_id, f1 || '@a.test' AS email FROM team_facts UNION SELECT page_id, f1 || '@a.test' FROM team_facts")
def team_page_emails(team_pages):
    return html.emails_of_pages(html.parse_pages(team_pages, parts=("text", "mailtos")))


_TITLES = "CASE role_raw WHEN 'sales manager' THEN 'Sales Manager' WHEN 'parts manager' THEN 'Parts Manager' WHEN 'dp' THEN 'Dealer Principal' WHEN 'gm' THEN 'General Manager' END"


@query(
    f"""SELECT release_id, email, full_name, role_raw, {_TITLES} AS role FROM (
      SELECT release_id, e1 AS email, n1 AS full_name, CASE WHEN kind = 2 THEN 'parts manager' WHEN kind IN (1, 4, 5) THEN 'sales manager' WHEN e1 = e2 THEN CASE WHEN e2 LIKE 'dp%' THEN 'dp' WHEN e2 LIKE 'gm%' THEN 'gm' ELSE 'sales manager' END END AS role_raw FROM release_mails
      UNION ALL
      SELECT release_id, e2, n2, CASE WHEN kind = 2 THEN 'parts manager' WHEN kind = 0 AND e2 LIKE 'dp%' THEN 'dp' WHEN kind = 0 AND e2 LIKE 'gm%' THEN 'gm' ELSE 'sales manager' END FROM release_mails WHERE e2 <> e1) AS r"""
)
def release_people(releases):
    """People of releases by tables (one in a heading's cell) and by text; links hide an address from its context."""
    return release.release_people(releases)


@query(
    """WITH made AS (SELECT list_pos, release_date, n3, CASE kind WHEN 0 THEN substr(f3, 1, 1) || l3 ELSE f3 || '.' || l3 END || '@' || dom AS email, CASE kind WHEN 0 THEN 'flast' ELSE 'first.last' END AS form FROM release_mails WHERE kind IN (0, 1))
    SELECT email, arg_min(n3, list_pos) AS name, 'Sales Manager' AS role_raw, 'Sales Manager' AS role, arg_min(form, list_pos) AS pattern, max(release_date) AS release_date FROM made
    WHERE email NOT IN (SELECT e1 FROM release_mails UNION ALL SELECT e2 FROM release_mails) GROUP BY email"""
)
def appointee_addresses(releases):
    """Guesses for the appointed: the formats of the client's own domain, where a release shows just one; agencies tell none."""
    return release.appointee_addresses(releases)


@query(
    f"""WITH mails AS (SELECT id, unnest([e1, e2, e3]) AS email FROM dealer_facts),
    page AS (SELECT id, email, row_number() OVER (PARTITION BY id ORDER BY email) AS seq FROM (SELECT DISTINCT id, email FROM mails WHERE email IS NOT NULL AND email NOT LIKE '%@yahoo.com' AND email NOT LIKE 'sales@%') AS x),
    api AS (SELECT id, lower(trim(api_email)) AS api FROM dealer_facts WHERE api_email IS NOT NULL),
    cand AS (SELECT id, 1 AS rank, seq, email FROM page JOIN dealer_facts USING (id) WHERE website_url IS NULL OR split_part(email, '@', 2) = own
      UNION ALL SELECT id, 2, seq, email FROM page UNION ALL SELECT id, 2, 1000, api FROM api WHERE api NOT LIKE '%@gmail.com' UNION ALL SELECT id, 3, 0, e0 FROM dealer_facts WHERE e0 IS NOT NULL),
    pat AS ({_patterns_sql('SELECT id * 10 + rank AS grp, email, seq FROM cand')}),
    best AS (SELECT grp // 10 AS id, arg_min(pattern, grp) AS pattern, arg_min(domain, grp) AS domain FROM pat WHERE pattern IS NOT NULL GROUP BY 1),
    g AS (SELECT f.id, best.pattern, coalesce(best.pattern, CASE WHEN api IS NOT NULL THEN 'first.last' END) AS form, coalesce(best.domain, split_part(api, '@', 2)) AS domain FROM dealer_facts AS f LEFT JOIN best USING (id) LEFT JOIN api USING (id)),
    known AS (SELECT id, split_part(email, '@', 1) AS lp, arg_max(email, rank * 10000 + seq) AS hit FROM cand WHERE rank > 1 GROUP BY 1, 2),
    folk AS (SELECT id, 'jsonld' AS found_in, f1 AS f, l1 AS l, e0 AS email, 'Parts Manager' AS role_raw FROM dealer_facts UNION ALL SELECT id, 'page', f2, l2, NULL, 'Sales Manager' FROM dealer_facts),
    tried AS (SELECT id, found_in, unnest([f || '.' || l, substr(f, 1, 1) || l, f, f || substr(l, 1, 1), l || '.' || f, l || substr(f, 1, 1), f || '_' || l, f || l]) AS lp, unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS turn FROM folk JOIN g USING (id) WHERE email IS NULL AND (found_in = 'page' OR form IS NOT NULL)),
    hits AS (SELECT id, found_in, arg_min(hit, turn) AS match FROM tried JOIN known USING (id, lp) GROUP BY 1, 2),
    done AS (SELECT id, found_in, f, l, role_raw, pattern, form, coalesce(email, match) AS had, coalesce(email, match, CASE form WHEN 'first.last' THEN f || '.' || l WHEN 'first_last' THEN f || '_' || l WHEN 'flast' THEN substr(f, 1, 1) || l WHEN 'first' THEN f END || '@' || domain) AS address
      FROM folk JOIN g USING (id) LEFT JOIN hits USING (id, found_in)),
    orphan AS (SELECT DISTINCT id, email, regexp_replace(split_part(email, '@', 1), '[._].*', '') AS f, regexp_replace(split_part(email, '@', 1), '.*[._]', '') AS l FROM cand WHERE rank > 1 AND regexp_matches(split_part(email, '@', 1), '^([a-z]{{2,}}[.][a-z]{{2,}}|[a-z]{{2,}}_[a-z]{{2,}})$')
      AND NOT EXISTS (SELECT 1 FROM done WHERE done.id = cand.id AND done.address = cand.email))
    SELECT id, {_CAP.format('f')} || ' ' || {_CAP.format('l')} AS full_name, role_raw, address AS email, CASE WHEN found_in = 'page' THEN pattern WHEN had IS NULL AND address IS NOT NULL THEN form END AS email_pattern, CASE WHEN had IS NULL AND address IS NOT NULL THEN 'inferred' ELSE 'direct' END AS confidence, found_in FROM done
    UNION ALL SELECT id, {_CAP.format('f')} || ' ' || {_CAP.format('l')}, NULL, email, NULL, 'direct', 'address' FROM orphan"""
)
def dealer_people(dealer_pages, dealer_facts):
    """Organisations whose pattern comes from addresses at the site, from others of the page, from structured data, from
    the locator's domain or from nowhere; people with an address of their own, one matched, one guessed or none; and
    addresses nobody got."""
    return fusion.fuse_people(dealer_pages, dealer_facts).select("id", "full_name", "role_raw", "email", "email_pattern", "confidence", "found_in")


@query("SELECT id, full_name, email, CAST(NULL AS VARCHAR) AS phone, source_date FROM contacts WHERE email IS NOT NULL")
def contacts_schema(contacts):
    """Contacts in the columns of the third version of their table, some of them."""
    return schemas.migrated(contacts.filter("email is not null"), "contacts", 3).select("id", "full_name", "email", "phone", "source_date")


@query(
    f"""WITH r AS (
      SELECT msg_id, e1 AS email, n1 AS full_name, 'service manager' AS role_raw, NULL AS reason FROM reply_names WHERE kind = 0
      UNION ALL SELECT msg_id, e2, n2, CASE WHEN e2 LIKE 'dp%' THEN 'dp' WHEN e2 LIKE 'gm%' THEN 'gm' ELSE 'parts interpreter' END, NULL FROM reply_names WHERE kind = 1
      UNION ALL SELECT msg_id, e1, n1, NULL, NULL FROM reply_names WHERE kind = 2
      UNION ALL SELECT msg_id, 'info@' || dom, NULL, NULL, 'role' FROM reply_names WHERE kind = 3
      UNION ALL SELECT msg_id, f1 || CAST(msg_id AS VARCHAR) || '@yahoo.com', NULL, NULL, 'freemail' FROM reply_names WHERE kind = 3
      UNION ALL SELECT msg_id, '99000000' || CAST(msg_id AS VARCHAR) || '@' || dom, NULL, NULL, 'opaque' FROM reply_names WHERE kind = 4)
    SELECT msg_id, email, full_name, role_raw, CASE role_raw WHEN 'service manager' THEN 'Service Manager' WHEN 'parts interpreter' THEN 'Parts Interpreter' WHEN 'dp' THEN 'Dealer Principal' WHEN 'gm' THEN 'General Manager' END AS role, reason FROM r"""
)
def reply_people(reply_mails):
    """People that replies name, by their address, by the words before it, or in a header; the sender is none of them."""
    return mail.harvest_replies(mail.parse_messages(reply_mails))


@query(
    """SELECT msg_id, 'ooo' AS kind, 'sam.sender@' || dom AS email FROM reply_facts"""
)
def reply_kinds(reply_mails):
    return mail.classify(mail.parse_messages(reply_mails, body=False)).select("msg_id", "kind", "email")


# ---- lists and stored tables


@query(
    """WITH p AS (SELECT *, min(CASE WHEN ids_text = '' OR page >= last_page THEN page END) OVER (PARTITION BY list_name) AS stop FROM release_pages WHERE page <= 6),
    ids AS (SELECT list_name, page, unnest(string_split(ids_text, ',')) AS id, generate_subscripts(string_split(ids_text, ','), 1) AS place FROM p WHERE stop IS NULL OR page <= stop),
    firsts AS (SELECT list_name, CAST(id AS BIGINT) AS release_id, min(page * 100 + place) AS place FROM ids WHERE id <> '' GROUP BY ALL)
    SELECT list_name, CAST(row_number() OVER (PARTITION BY list_name ORDER BY place) AS INTEGER) AS list_pos, release_id FROM firsts"""
)
def release_lists(release_pages):
    """Ids of lists as far as they are read, six pages at most, each at its first place."""
    ids = F.when(F.col("ids_text") != "", F.transform(F.split("ids_text", ","), lambda x: x.try_cast("long"))).otherwise(F.array().cast("array<long>"))
    return release.release_list(release_pages.withColumn("ids", ids), 6)


@query(
    """WITH o AS (SELECT id, email, full_name FROM contacts WHERE email IS NOT NULL AND id % 3 <> 1), n AS (SELECT id + 100000 AS id, email, full_name || '!' AS full_name FROM contacts WHERE email IS NOT NULL AND id % 4 = 0)
    SELECT coalesce(o.id, n.id) AS id, email, coalesce(n.full_name, o.full_name) AS full_name FROM o FULL JOIN n USING (email)"""
)
def stored_upsert(contacts):
    """A stored table after a day's changes: known addresses get the new name, others are added."""
    spark, rows = contacts.sparkSession, contacts.filter("email is not null").select("id", "email", "full_name")
    path = tables.shared_path(spark, "contacts-store")
    tables.create(rows.filter("id % 3 <> 1"), path, ["email"], 16)
    changes = rows.filter("id % 4 = 0").select((F.col("id") + 100000).alias("id"), "email", F.concat("full_name", F.lit("!")).alias("full_name"))
    tables.apply(spark, path, changes, ["email"], 16, [F.col("id")], lambda c, old, new: new if c == "full_name" else old)
    return tables.load(spark, path)


@query("SELECT id, full_name, email, CASE WHEN id % 3 = 2 THEN suppressed END AS suppressed, CASE WHEN id % 3 = 2 THEN source_date END AS source_date, CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 3 END AS version FROM contacts")
def stored_versions(contacts):
    """Files of the first and the third version of a table, of which one kept numbers as text, read as the third."""
    spark, paths = contacts.sparkSession, [tables.shared_path(contacts.sparkSession, f"contacts-{k}") for k in range(3)]
    old = contacts.select("id", "full_name", "email")
    for path, rows in zip(paths, (old.filter("id % 3 = 0"), old.filter("id % 3 = 1").withColumn("id", F.col("id").cast("string")), contacts.filter("id % 3 = 2").select("id", "full_name", "email", "suppressed", "source_date", "export_batch")), strict=True):
        rows.write.parquet(path)
    return schemas.stored(spark, paths, "contacts", 3).select("id", "full_name", "email", "suppressed", "source_date", "version")


@query(
    """WITH o AS (SELECT id, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'https://www.google.com/maps/place/' || CAST(id AS VARCHAR) ELSE website_url END AS site FROM dealerships WHERE id % 7 <> 0), n AS (SELECT id, CASE WHEN id % 10 = 0 THEN NULL ELSE 'https://new' || CAST(id AS VARCHAR) || '.test' END AS site FROM dealerships WHERE id % 3 <> 0)
    SELECT id, CASE WHEN o.id IS NULL THEN n.site WHEN n.id IS NOT NULL AND (o.site IS NULL OR contains(o.site, 'google.com/maps')) THEN n.site ELSE o.site END AS site, o.id IS NULL AS inserted FROM o FULL JOIN n USING (id)"""
)
def upsert_site(dealerships):
    """A site gives way to a new one only where it is missing or a map's."""
    at = F.col("id") % 4
    old = dealerships.filter("id % 7 <> 0").select("id", F.when(at == 0, None).when(at == 1, F.concat(F.lit("https://www.google.com/maps/place/"), "id")).otherwise(F.col("website_url")).alias("site"))
    new = dealerships.filter("id % 3 <> 0").select("id", F.when(F.col("id") % 10 != 0, F.concat(F.lit("https://new"), "id", F.lit(".test"))).alias("site"))
    return state.upsert(old, new, ["id"], [F.col("id")], state.replace_if("site", state.site_unknown))


# ---- lookups, probes, flags and stamps


@query(
    """SELECT domain, CASE WHEN hosts > 0 THEN '' WHEN n = 0 THEN 'nxdomain' WHEN n IN (1, 2, 4) THEN 'no_mx' ELSE 'dns_error:Timeout' END AS lookup
    FROM (SELECT domain, count(host) AS hosts, length(domain) % 5 AS n FROM lookups GROUP BY domain) AS x"""
)
def lookup_status(lookups):
    return people.lookup_status(lookups)


@query("SELECT email_domain, arg_min(host, preference * 1000 + k) AS verify_mx, CAST(turn AS INTEGER) AS turn, id, email FROM (SELECT c.*, row_number() OVER (PARTITION BY email_domain ORDER BY id) AS turn FROM contacts AS c WHERE email IS NOT NULL) AS c JOIN (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY host) AS k FROM mx_records) AS m ON m.domain = email_domain GROUP BY email_domain, turn, id, email")
def probe_order(contacts, mx_records):
    hosts = people.mx_hosts(mx_records).select(F.col("domain").alias("email_domain"), F.get("hosts", F.lit(0)).alias("verify_mx"))
    return people.probe_order(contacts.filter("email is not null").join(hosts, "email_domain"))


@query(
    """WITH asked AS (SELECT DISTINCT o_custkey + CASE WHEN o_orderkey % 9 = 0 THEN 10000000 ELSE 0 END AS id FROM orders WHERE o_orderkey % 7 = 0 OR o_custkey % 29 = 0)
    SELECT a.id, CASE WHEN c.id IS NULL THEN 'not_found' WHEN suppress_reason = 'left_employer' THEN 'cleared' ELSE 'flagged' END AS outcome, CASE WHEN c.id IS NULL THEN NULL WHEN suppress_reason = 'left_employer' THEN 'in_play' ELSE 'ruled_out' END AS disposition
    FROM asked AS a LEFT JOIN contacts AS c ON c.id = a.id"""
)
def stale_toggle(contacts, orders):
    """What turning the flag of some ids gives: some have it, some get it, some are nobody's."""
    asked = orders.filter("o_orderkey % 7 = 0 or o_custkey % 29 = 0").select((F.col("o_custkey") + F.when(F.col("o_orderkey") % 9 == 0, 10_000_000).otherwise(0)).alias("id"))
    rows, outcome = state.toggle_stale(contacts, asked)
    return outcome.join(rows.select("id", "disposition"), "id", "left")


@query(f"SELECT id, CASE WHEN id IN ({_RECENT_BATCH}) THEN 'NP-B01' ELSE send_group END AS send_group FROM contacts")
def recent_batch_stamp(contacts, subscriber_states):
    names = subscriber_states.filter("state = 'active'").select(S.name_key(F.col("name")).alias("name_key"))
    return state.stamp_group(contacts, read.recent_batch(contacts, names, F.expr(AS_OF))).select("id", "send_group")


@query(
    """WITH shown AS (SELECT release_id, e1 AS email FROM release_mails UNION SELECT release_id, e2 FROM release_mails),
    made AS (SELECT CASE kind WHEN 0 THEN substr(f3, 1, 1) || l3 ELSE f3 || '.' || l3 END || '@' || dom AS email FROM release_mails WHERE kind IN (0, 1))
    SELECT (SELECT count(*) FROM releases) AS releases, 0 AS missing, (SELECT count(*) FROM shown) AS candidates, (SELECT count(DISTINCT email) FROM shown) AS contacts,
      (SELECT count(*) FROM release_mails WHERE kind <> 2) AS appointment_releases, (SELECT count(*) FROM release_mails WHERE kind <> 2) AS appointees_named, (SELECT count(DISTINCT email) FROM made WHERE email NOT IN (SELECT email FROM shown)) AS extrapolated"""
)
def release_counts(releases):
    return release.release_counts(releases)
