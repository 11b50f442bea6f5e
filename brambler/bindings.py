"""Domain tables derived from the driver's tables, once, as SQL text that Spark and DuckDB read alike.

The driver has no contact data, so organisations, contacts, send events and the rest are computed from its rows by
fixed arithmetic. A query names the tables it needs; with_tables() puts them and what they rest on before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")
#: Queries never look at the clock.
AS_OF = "DATE '2024-01-31'"
#: Tables of texts that Python reads row by row, and the keys by which the rows they are made of are dealt out before.
READ_BY_PYTHON = {"team_pages", "link_pages", "dealer_pages", "releases", "reply_mails"}
DEALT_BY = {"supplier": "s_suppkey", "orders": "o_orderkey", "customer": "c_custkey"}


def _pick(words: list[str], number: str) -> str:
    """SQL for one of some words by a number, from one literal of fixed width."""
    width = max(map(len, words))
    text = "".join(w.ljust(width) for w in words)
    return f"trim(substr('{text}', CAST(({number}) % {len(words)} AS INT) * {width} + 1, {width}))"


FIRST = ["avery", "blake", "casey", "devon", "ellis", "finley", "gray", "harper", "indigo", "jules", "kendall", "logan", "morgan", "nico", "oakley", "parker", "quinn", "reese", "sage", "taylor", "umber", "val", "wren", "xen", "yael", "zion", "arden", "briar", "cleo", "drew"]
LAST = ["adler", "birch", "calder", "dune", "eaves", "frost", "glade", "heath", "isles", "jarrow", "keel", "larch", "marsh", "north", "oaks", "pike", "quarry", "ridge", "stone", "thorn", "upton", "vale", "weir", "yarrow", "zell"]
DOMAINS = [f"{w}.{t}" for w in ("alpha", "bravo", "delta", "fleet-hub", "garage1", "harbour", "ford-north", "bosch", "havas", "marketing-co") for t in ("example.au", "example.com", "example.de", "test")]
ROLE_LOCALS = ["sales", "info", "service.dept", "accounts", "parts", "noreply"]
ROLES = ["Dealer Principal", "New Car Sales Manager", "Senior Sales Consultant", "Service Advisor", "Parts Interpreter", "Fleet & Sales Manager", "Gardener", "Finance Manager ", "DP", "Receptionist", "New Car Manager"]

#: A payload of each brand; #n to #e stand for name, address, suburb, state, postcode, phone, site and email, #i for a number.
PAYLOADS = {
    "toyota": '{"results":[{"dealerCode":"#i","name":" #n ","address":"#a","city":"#u","state":"#s","postCode":"#p","telephone":"#h","webSite":"#w","email":"#e"}]}',
    "mitsubishi": '{"data":{"stockists":{"locations":[{"identifier":"#i","name":"#n","website":"#w","address":{"street":"#a","city":"#u","region":"#s","postcode":"#p","phone":"#h"}}]}}}',
    "hyundai": '[{"tradingName":"#n","streetName":"#a","suburb":"#u","state":"#s","postcode":"#p","phone":"#h","url":"#w","email":"#e"}]',
    "kia": '{"dataInfo":[{"dealerNm":"#n","addr":"#u","area":"#s","addrSC":"#a, #p","phone":"#h","homepage":"#w","email":"#e,x@b.test"}]}',
    "ford": '[{"name":"Ford #n","text":"#a #u #s #p #h"}]',
    "audi": '[{"name":"Audi #n","text":"#a #u #s #p #h"},{"name":"Other","text":""}]',
    "volvo": '[{"name":"Volvo #n","text":"#a #u #s #p #h"},{"name":"Volvo #n","text":""}]',
    "mazda": '[{"name":"#n","address":"#a","suburb":"#u","state":"#s","postCode":"#p","website":"#w","departments":[{"phone":""},{"phone":"#h","email":"#e"}]}]',
    "nissan": '{"dealers":[{"name":"#n","address":{"addressLine1":"#a","city":"#u","stateCode":"#s","postalCode":"#p"},"contact":{"phones":[{"value":"#h"}],"websites":[{"url":"#w"}]},"departments":[{"contact":{}},{"contact":{"email":"#e"}}]}]}',
    "isuzu": '{"Dealers":[{"Name":"#n","IsActive":true,"Sales":{"IsActive":false,"Contact":{"Phone":"1"}},"Parts":{"IsActive":true,"Address":{"Street":"#a","Suburb":"#u","State":"#s","PostCode":"#p"},"Contact":{"Phone":"#h","Website":{"Url":"#w"},"Email2":"#e"}}}]}',
    "honda": '[{"Name":"#n","State":"#s","Website":"#w","Locations":[{"AddressSuburb":"no"},{"isPrimary":true,"AddressLine1":"#a","AddressSuburb":"#u","AddressPostcode":"#p","Phone":"#h"}]}]',
    "subaru": '[{"name":"#n","state":"#s","isActive":true,"dealerDetails":[{"address":"#a","suburb":"#u","postCode":"#p","phone":"#h","url":"#w","email":"#e"}]},{"name":"off","isActive":false}]',
    "bmw": '{"data":{"pois":[{"name":"#n","street":"#a","city":"#u","state":"#s","postalCode":"#p","attributes":{"phone":"#h","homepage":"#w","mail":"#e"}}]}}',
    "mercedes": '{"dealers":[{"legalName":"#n","url":"#w","address":{"addressLine1":"#a","city":"#u","stateProvince":"","region":"#s","postalCode":"#p"},"contact":{"phone":"#h"}}]}',
    "ldv": '{"result":{"data":{"allCmsBrandDealer":{"nodes":[{"name":"#n","address":"#a","suburb":"#u","state":"#s","postcode":"#p","phone":"#h","contactUrl":"#w","email":"#e"}]}}}}',
    "volkswagen": '{"dealers":[{"dealer":{"dealerCode":"#i","dealerName":"#n","dealerState":"#s","SalesSuberbCode":"#u","dealerAddress":"#a","dealerPostcode":"#p","phone":"#h","dealerWebsite":"#w","FinanceEmail":"#e"}}]}',
    "jeep": '{"dealers":[{"id":"#i","name":"#n","phone":"#h","web_site":"#w","address":{"line1":"#a","city":"#u","state":"#s","postal_code":"#p"}}]}',
    "mg": '{"#s":{"code":3000,"result":{"Dealer_List":[{"Name":"#n","Showroom_Address":"#a, #u #s #p","Phone_Number":"#h","MG_Website":"#w"}]}},"XX":{"code":2955,"result":{"Dealer_List":[{"Name":"no"}]}}}',
    "byd": '[{"name":"#n","website":"#w","rawText":"Store Megastore Closest #a,Town #s #p Visit"}]',
    "gwm": '[{"name":"#n","address":"#a, #u, #s, #p","phone":"#h","email":"#e"}]',
}
_PAYLOAD = "CASE s_suppkey % 20 " + " ".join(f"WHEN {k} THEN '{text}'" for k, text in enumerate(PAYLOADS.values())) + " END"
for _mark, _value in {"#n": "name", "#a": "address", "#u": "suburb", "#s": "state", "#p": "postcode", "#h": "phone", "#w": "website_url", "#e": "api_email", "#i": "CAST(seq AS STRING)"}.items():
    _PAYLOAD = f"replace({_PAYLOAD}, '{_mark}', {_value})"

TABLES = {
    "team_facts": f"""
        SELECT s_suppkey AS page_id, {_pick(FIRST, "s_suppkey")} AS f1, {_pick(LAST, "s_suppkey")} AS l1, {_pick(FIRST, "s_suppkey + 7")} AS f2, {_pick(LAST, "s_suppkey + 11")} AS l2,
          'https://www.site' || CAST(s_suppkey AS STRING) || '.test/' AS url, s_suppkey % 3 AS kind
        FROM supplier""",
    "link_facts": f"""
        SELECT s_suppkey AS page_id, 'https://www.site' || CAST(s_suppkey AS STRING) || '.test/x/' AS url,
          'https://www.site' || CAST(s_suppkey AS STRING) || '.test' || {_pick(["/our-team", "/meet-the-team", "/the-team", "/team", "/staff", "/people", "/about-us/team", "/about/staff", "/cars", "/about-us"], "s_suppkey * 3")} || {_pick(["", "/", "/sales?x=1", ".pdf", "#top"], "s_suppkey")} AS h1,
          {_pick(["Our Team", "About us", "Contact", "MEET THE TEAM today", "Our people"], "s_suppkey * 7 + 1")} AS t1,
          'https://www.site' || CAST(s_suppkey AS STRING) || '.test/x/' || {_pick(["Staff", "about", "about.png?v=2", "cars/team", "new"], "s_suppkey * 2 + 1")} AS h2, {_pick(["about", "Team Members", "more", "our staff"], "s_suppkey + 2")} AS t2,
          'https://www.site' || CAST(s_suppkey AS STRING) || '.test/team' AS h3, {_pick(["x", "the team"], "s_suppkey")} AS t3
        FROM supplier""",
    "link_pages": """
        SELECT page_id, url, '<body><a href="' || h1 || '">' || t1 || '</a><a href="https://other.test/team">Our Team</a><a href="' || substr(h2, length(url) + 1) || '"><b>' || t2 || '</b></a><a href="#team">team</a><a href="/team"> ' || t3 || '</a>' AS html
        FROM link_facts""",
    # pages of three kinds: cards, structured data beside a heading with a role, and plain text
    "team_pages": """
        SELECT page_id, url, '<html><head><script>var x = "no@script.test";</script></head><body><a href="/our-team/">Meet the team</a><a href="/about">About</a><a href="https://other.test/our-team">x</a><a href="mailto:' || f1 || '@a.test">mail</a>' ||
          CASE kind WHEN 0 THEN '<div class="team-card"><h3>' || upper(substr(f1, 1, 1)) || substr(f1, 2) || ' ' || upper(substr(l1, 1, 1)) || substr(l1, 2) || '</h3><p>Sales Manager</p></div><div class="team-card"><h3>Toyota Corolla</h3><p>From 9</p></div><div class="team-card"><h3>Sales Manager</h3></div>'
            WHEN 1 THEN '<script type="application/ld+json">{"@type":"Person","name":"' || f1 || ' ' || l1 || '","jobTitle":"Director","email":"' || upper(f1) || '@A.test"}</script><h2>' || upper(substr(f2, 1, 1)) || substr(f2, 2) || ' Head</h2><p>Service Advisor</p><h2>Our Team</h2><p>Manager</p>'
            ELSE '<p>' || upper(substr(f2, 1, 1)) || substr(f2, 2) || ' ' || upper(substr(l2, 1, 1)) || substr(l2, 2) || ' - Parts Manager</p>' END ||
          '</body></html>' AS html
        FROM team_facts""",
    # organisations of eight kinds by what their page and listing tell: see dealer_people
    "dealer_names": f"""
        SELECT s_suppkey AS id, s_suppkey % 8 AS kind, {_pick(FIRST, "s_suppkey")} AS f1, {_pick(LAST, "s_suppkey")} AS l1, {_pick(FIRST, "s_suppkey * 3 + 7")} AS f2, {_pick(LAST, "s_suppkey * 3 + 11")} AS l2,
          {_pick(FIRST, "s_suppkey * 7 + 3")} AS f3, {_pick(LAST, "s_suppkey * 7 + 5")} AS l3, {_pick(FIRST, "s_suppkey * 11 + 1")} AS f4, {_pick(LAST, "s_suppkey * 11 + 2")} AS l4,
          'site' || CAST(s_suppkey AS STRING) || '.test' AS own, 'group' || CAST(s_suppkey % 9 AS STRING) || '.test' AS wide FROM supplier""",
    "dealer_facts": """
        SELECT id, kind, f1, l1, f2, l2, own, wide, CASE kind WHEN 6 THEN NULL ELSE 'https://www.' || own || '/home?x=1' END AS website_url,
          CASE kind WHEN 3 THEN ' Office@' || wide WHEN 7 THEN 'depot@gmail.com' WHEN 0 THEN 'office.x@' || wide ELSE NULL END AS api_email,
          CASE kind WHEN 2 THEN f1 || '.' || l1 || '@' || own ELSE NULL END AS e0,
          CASE kind WHEN 0 THEN f3 || '.' || l3 || '@' || own WHEN 1 THEN f3 || '_' || l3 || '@' || wide WHEN 2 THEN f3 || '.' || l3 || '@yahoo.com' WHEN 5 THEN f3 || '@' || own WHEN 6 THEN f3 || '.' || l3 || '@' || wide ELSE NULL END AS e1,
          CASE kind WHEN 0 THEN f4 || '.' || l4 || '@' || own WHEN 1 THEN f2 || '_' || l2 || '@' || wide WHEN 5 THEN substr(f4, 1, 1) || l4 || '@' || own WHEN 6 THEN f4 || l4 || '@' || own ELSE NULL END AS e2,
          CASE kind WHEN 1 THEN f4 || '_' || l4 || '@' || wide WHEN 6 THEN f2 || '.' || l2 || '@' || wide WHEN 0 THEN 'sales@' || own ELSE NULL END AS e3
        FROM dealer_names""",
    "dealer_pages": """
        SELECT id, 'https://www.' || own || '/team' AS url, '<html><body><script type="application/ld+json">{"@type":"Person","name":"' || upper(substr(f1, 1, 1)) || substr(f1, 2) || ' ' || upper(substr(l1, 1, 1)) || substr(l1, 2) || '","jobTitle":"Parts Manager"' || coalesce(',"email":"' || upper(e0) || '"', '') || '}</script><div class="team-card"><h3>' ||
          upper(substr(f2, 1, 1)) || substr(f2, 2) || ' ' || upper(substr(l2, 1, 1)) || substr(l2, 2) || '</h3>Welcome<p>Sales Manager</p></div><div class="staff"><h4>' || upper(substr(f1, 1, 1)) || substr(f1, 2) || ' ' || upper(substr(l1, 1, 1)) || substr(l1, 2) || '</h4></div>' ||
          coalesce('<p>' || e1, '') || coalesce('<p><a href="mailto:' || upper(e2) || '?subject=x">mail</a>', '') || coalesce('<p>' || e3 || '</p>', '') || '</body></html>' AS html
        FROM dealer_facts""",
    # releases of customers: contacts in a table or in the text, at the client's domain or an agency's, with or without an appointment
    "release_facts": f"""
        SELECT o_orderkey AS release_id, o_orderkey AS list_pos, o_custkey, o_orderkey % 6 AS kind, CAST(o_orderdate AS DATE) AS release_date, 'acme' || chr(CAST(97 + o_custkey % 20 AS INT)) AS word,
          {_pick(FIRST, "o_orderkey")} AS f1, {_pick(LAST, "o_orderkey")} AS l1, {_pick(FIRST, "o_orderkey * 3 + 7")} AS f2, {_pick(LAST, "o_orderkey * 3 + 11")} AS l2, {_pick(FIRST, "o_custkey * 7 + 3")} AS f3, {_pick(LAST, "o_orderkey * 7 + 5")} AS l3 FROM orders""",
    "release_shown": """
        SELECT *, CASE WHEN kind = 4 THEN 'msl.test' WHEN kind = 5 THEN 'other' || CAST(o_custkey % 7 AS STRING) || '.test' ELSE word || 'cars.test' END AS dom,
          upper(substr(f1, 1, 1)) || substr(f1, 2) || ' ' || upper(substr(l1, 1, 1)) || substr(l1, 2) AS n1, upper(substr(f2, 1, 1)) || substr(f2, 2) || ' ' || upper(substr(l2, 1, 1)) || substr(l2, 2) AS n2, upper(substr(f3, 1, 1)) || substr(f3, 2) || ' ' || upper(substr(l3, 1, 1)) || substr(l3, 2) AS n3
        FROM release_facts""",
    "release_mails": """
        SELECT *, CASE WHEN kind IN (0, 3) THEN substr(f1, 1, 1) || l1 ELSE f1 || '.' || l1 END || '@' || dom AS e1, CASE WHEN kind = 0 THEN substr(f2, 1, 1) || l2 ELSE f2 || '.' || l2 END || '@' || dom AS e2 FROM release_shown""",
    "releases": """
        SELECT release_id, list_pos, 'Acme' || substr(word, 5) || ' Motors' AS client_name, CASE WHEN kind = 2 THEN 'New model' ELSE ' Changes ' END AS title, release_date,
          CASE WHEN kind = 2 THEN '<p>The new model is out.</p>' ELSE '<p>The board has appointed ' || n3 || ' as Sales Manager from March.</p>' END ||
          CASE WHEN kind IN (0, 3) THEN '<table><tr><th>For further information<table><tr><td>logo</td></tr></table></th></tr><tr><td>' || n1 || '</td><td>' || n2 || '</td></tr><tr><td>1234</td></tr><tr><td><a href="mailto:' || upper(e1) || '">mail</a></td><td>' || e2 || '</td></tr></table>'
            ELSE '<p>Write to our parts manager at ' || e1 || ' or at media@' || dom || ', x@yahoo.com; ' || e2 || '</p>' END AS content_html
        FROM release_mails""",
    # pages of lists of releases: ids come again on later pages, some pages are empty, some lists tell their last page
    "release_pages": """
        SELECT o_custkey AS list_name, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS page, CASE WHEN o_custkey % 5 = 0 THEN 3 END AS last_page,
          CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_orderkey - o_orderkey % 4 AS STRING) || ',' || CAST(o_custkey AS STRING) || ',,' || CAST(o_orderkey AS STRING) END AS ids_text
        FROM orders""",
    "locator_facts": f"""
        SELECT s_suppkey, s_suppkey AS seq, {_pick(list(PAYLOADS), "s_suppkey")} AS brand_slug, 'Motors ' || CAST(s_suppkey AS STRING) AS name, CAST(s_suppkey AS STRING) || ' Long Road' AS address, 'Town' AS suburb,
          {_pick(["NSW", "VIC", "QLD", "WA"], "s_suppkey")} AS state, CAST(3000 + s_suppkey % 900 AS STRING) AS postcode, '(03) 5550 ' || CAST(1000 + s_suppkey % 9000 AS STRING) AS phone,
          'https://www.d' || CAST(s_suppkey AS STRING) || '.test' AS website_url, 'D' || CAST(s_suppkey AS STRING) || '@A.test' AS api_email
        FROM supplier""",
    "locator_payloads": f"SELECT brand_slug, seq, {_PAYLOAD} AS payload_json FROM locator_facts",
    "dealerships": """
        SELECT s_suppkey AS id, 'brand_' || CAST(s_suppkey % 20 AS STRING) AS brand_slug, s_name AS name,
          CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE n_name END AS suburb, r_name AS state,
          CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'site' || CAST(s_suppkey AS STRING) || '@' || DOMAIN_S END AS api_email,
          CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'https://www.' || DOMAIN_S || '/team?x=1' END AS website_url,
          CASE WHEN s_suppkey % 4 = 0 THEN 'discovered' WHEN s_suppkey % 4 = 1 THEN 'team_found' WHEN s_suppkey % 4 = 2 THEN 'scraped' ELSE 'extracted' END AS scrape_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""".replace("DOMAIN_S", _pick(DOMAINS, "s_suppkey * 7")),
    "contacts_all": f"""
        SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN CAST((c_custkey - c_custkey % 4) / 4 AS BIGINT) % 100 END AS dealership_id,
          {_pick(FIRST, "c_custkey % 750")} AS first_name, {_pick(LAST, "c_custkey % 750")} AS last_name,
          CASE WHEN c_custkey % 2 = 0 THEN {_pick(DOMAINS, "c_custkey % 150 + CAST((c_custkey - c_custkey % 150) / 150 AS BIGINT) % 3 * 7")}
            ELSE {_pick(DOMAINS, "c_custkey % 41 + c_custkey % 7")} END AS email_domain,
          CASE WHEN c_custkey % 23 = 0 THEN {_pick(ROLE_LOCALS, "c_custkey % 6")}
            ELSE {_pick(FIRST, "c_custkey % 750")} || '.' || {_pick(LAST, "c_custkey % 750")} END AS local_part,
          CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {_pick(ROLES, "c_custkey")} END AS role_raw,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'team_page' WHEN 'AUTOMOBILE' THEN 'ooo_reply' WHEN 'MACHINERY' THEN 'newspress'
            WHEN 'HOUSEHOLD' THEN 'newspress_appointment' ELSE 'manual' END AS source,
          CASE WHEN c_custkey % 5 = 0 THEN 'inferred' ELSE 'direct' END AS confidence,
          c_custkey % 29 = 0 AS suppressed, CASE WHEN c_custkey % 29 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'media_domain' ELSE 'left_employer' END END AS suppress_reason,
          CASE c_custkey % 9 WHEN 0 THEN 'active' WHEN 1 THEN 'unsubscribed' WHEN 2 THEN 'deleted' WHEN 3 THEN NULL ELSE 'not_found' END AS cm_status,
          CASE WHEN c_custkey % 31 = 0 THEN 'sent' WHEN c_custkey % 8 = 0 THEN 'ruled_out' ELSE 'in_play' END AS disposition,
          CASE WHEN c_custkey % 8 = 0 AND c_custkey % 31 <> 0 THEN CASE c_custkey % 3 WHEN 0 THEN 'cm-active' WHEN 1 THEN 'wp-member' ELSE 'suppressed' END END AS ruled_out_stage,
          CASE c_custkey % 10 WHEN 0 THEN 'role' WHEN 1 THEN 'unknown_gateway' WHEN 2 THEN 'undeliverable' WHEN 3 THEN 'dead_domain' WHEN 4 THEN NULL ELSE 'unknown' END AS verify_status,
          CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 30 AS INT) END AS export_batch,
          CASE c_custkey % 6 WHEN 0 THEN 'dealer' WHEN 1 THEN 'T1' WHEN 2 THEN 'T2' WHEN 3 THEN 'T3' WHEN 4 THEN 'T4' ELSE NULL END AS proximity_tier,
          CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE DATE '2022-01-01' + CAST(c_custkey % 900 AS INT) END AS source_date,
          CASE WHEN c_custkey % 12 = 0 THEN DATE '2023-06-01' + CAST(c_custkey % 90 AS INT) END AS ooo_at,
          CASE WHEN c_custkey % 31 = 0 THEN DATE '2023-11-01' + CAST(c_custkey % 60 AS INT) END AS sent_at,
          CASE c_custkey % 5 WHEN 0 THEN 'newspress: Client ' || CAST(c_custkey % 37 AS STRING) || ' — New model' WHEN 1 THEN 'newspress: no dash' ELSE NULL END AS source_detail,
          CAST(NULL AS STRING) AS company
        FROM customer""",
    "contacts_ranked": """
        SELECT *, local_part || '@' || email_domain AS full_email,
          row_number() OVER (PARTITION BY local_part, email_domain ORDER BY id) AS repeat_no FROM contacts_all""",
    "contacts": """
        SELECT id, dealership_id, first_name || ' ' || last_name AS full_name, first_name, last_name, role_raw,
          CASE WHEN id % 11 = 0 OR repeat_no > 1 THEN NULL ELSE full_email END AS email,
          CASE WHEN id % 11 = 0 OR repeat_no > 1 THEN NULL ELSE email_domain END AS email_domain,
          source, confidence, suppressed, suppress_reason, cm_status, disposition, ruled_out_stage,
          CASE WHEN ruled_out_stage IS NOT NULL THEN 'earlier' END AS ruled_out_reason,
          verify_status, export_batch, CASE WHEN export_batch IS NOT NULL THEN 'G' || CAST(export_batch % 7 AS STRING) END AS send_group,
          proximity_tier, source_date, ooo_at, sent_at, source_detail, company
        FROM contacts_ranked""",
    "subscriber_states": """
        SELECT CASE WHEN id % 4 = 0 THEN 'Campaign-warm' ELSE 'Newsletter' END AS list_name,
          CASE id % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'unsubscribed' ELSE 'deleted' END AS state, upper(email) AS email, full_name AS name
        FROM contacts WHERE email IS NOT NULL AND id % 7 = 0
        UNION ALL
        SELECT 'Weekly' AS list_name, CASE WHEN id % 2 = 0 THEN 'deleted' ELSE 'active' END AS state, email, last_name || ', ' || first_name AS name
        FROM contacts WHERE email IS NOT NULL AND id % 13 = 0""",
    "accounts": "SELECT upper(email) AS email FROM contacts WHERE email IS NOT NULL AND id % 19 = 0",
    "send_events": """
        SELECT event_id AS id, user_id AS contact_id,
          CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'delivered' WHEN 'error' THEN 'bounced' WHEN 'click' THEN 'opened'
            ELSE CASE WHEN value > 80 THEN 'complained' ELSE 'clicked' END END AS event,
          CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'soft' ELSE 'hard' END END AS bounce_type, ts AS occurred_at
        FROM events""",
    "mx_records": """
        SELECT email_domain AS domain, CAST(n % 3 AS INT) * 10 AS preference,
          CASE n % 5 WHEN 0 THEN 'aspmx.l.google.com' WHEN 1 THEN 'x.mail.protection.outlook.com' WHEN 2 THEN 'mx.secureserver.net' WHEN 3 THEN 'mail.cpanel.host' ELSE 'mx1.' || email_domain END AS host
        FROM (SELECT email_domain, length(email_domain) + ascii(email_domain) AS n FROM (SELECT DISTINCT email_domain FROM contacts WHERE email_domain IS NOT NULL) AS d) AS numbered
        WHERE n % 7 <> 0
        UNION ALL
        SELECT DISTINCT email_domain AS domain, 50 AS preference, 'backup.' || email_domain AS host FROM contacts WHERE email_domain IS NOT NULL AND length(email_domain) % 3 = 0""",
    "lookups": """
        SELECT domain, preference, host, CAST(NULL AS STRING) AS error FROM mx_records
        UNION ALL
        SELECT email_domain AS domain, CAST(NULL AS INT) AS preference, CAST(NULL AS STRING) AS host, CASE length(email_domain) % 5 WHEN 0 THEN 'NXDOMAIN' WHEN 1 THEN 'NoAnswer' WHEN 2 THEN 'NoNameservers' WHEN 3 THEN 'Timeout' ELSE NULL END AS error
        FROM (SELECT DISTINCT email_domain FROM contacts WHERE email_domain IS NOT NULL) AS d""",
    "rcpt_results": """
        SELECT email AS address, CASE WHEN length(email_domain) % 5 = 0 THEN 250 ELSE 550 END AS catchall_code,
          CASE id % 6 WHEN 0 THEN 250 WHEN 1 THEN 251 WHEN 2 THEN 550 WHEN 3 THEN 553 WHEN 4 THEN 451 ELSE 521 END AS code
        FROM contacts WHERE email IS NOT NULL""",
    "archive_whole": """
        SELECT o_orderkey AS mail_id, '"' || c.full_name || '" <' || upper(c.email) || '>' AS to_header, o_orderkey % 3 <> 0 AS is_outgoing,
          CAST(o_orderdate AS DATE) AS sent_on, CASE WHEN o_orderkey % 4 = 0 THEN 'read THE MARKER here' ELSE 'plain' END AS body
        FROM orders JOIN contacts AS c ON c.id = o_custkey WHERE c.email IS NOT NULL""",
    "archive_accounts": """
        SELECT o_orderkey AS mail_id, CASE o_orderkey % 3 WHEN 0 THEN 'Desk@a.test' WHEN 1 THEN 'second@a.test' ELSE NULL END AS account_email, c.full_name || ' <x' || upper(c.email) || '.au>, ' || 'Somebody@other.test' AS to_header, o_orderkey % 4 <> 0 AS is_outgoing,
          CAST(o_orderdate AS DATE) AS sent_on, CASE WHEN o_orderkey % 5 = 0 THEN 'read THE MARKER here' ELSE 'plain' END AS body, CASE WHEN o_orderkey % 7 = 0 THEN '<p>the marker</p>' ELSE NULL END AS html_body
        FROM orders JOIN contacts AS c ON c.id = o_custkey WHERE c.email IS NOT NULL""",
    "sender_accounts": "SELECT DISTINCT CASE n_regionkey WHEN 0 THEN ' DESK@a.test' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'none@a.test' END AS email FROM nation",
    # replies that name people by address, by words near one, in a header, or none that count
    "reply_facts": f"""
        SELECT c_custkey AS msg_id, c_custkey % 6 AS kind, {_pick(FIRST, "c_custkey")} AS f1, {_pick(LAST, "c_custkey")} AS l1, {_pick(FIRST, "c_custkey * 3 + 7")} AS f2, {_pick(LAST, "c_custkey * 3 + 11")} AS l2, 'c' || CAST(c_custkey AS STRING) || '.test' AS dom FROM customer""",
    "reply_names": """
        SELECT *, upper(substr(f1, 1, 1)) || substr(f1, 2) || ' ' || upper(substr(l1, 1, 1)) || substr(l1, 2) AS n1, upper(substr(f2, 1, 1)) || substr(f2, 2) || ' ' || upper(substr(l2, 1, 1)) || substr(l2, 2) AS n2,
          f1 || '.' || l1 || '@' || dom AS e1, substr(f2, 1, 1) || l2 || '@' || dom AS e2 FROM reply_facts""",
    "reply_mails": """
        SELECT msg_id, 'From: "Sam Sender" <Sam.Sender@' || dom || '>' || chr(10) || 'Subject: Automatic reply: hello' || chr(10) || 'Auto-Submitted: auto-replied' || chr(10) || CASE WHEN kind = 2 THEN 'Reply-To: "' || n1 || '" <' || upper(e1) || '>' || chr(10) ELSE '' END || chr(10) ||
          CASE kind WHEN 0 THEN 'I am away.' || chr(10) || 'Please contact our Service Manager ' || n1 || ' at ' || e1 || '.' WHEN 1 THEN 'You may ask for ' || n2 || ', our parts interpreter, at <' || e2 || '>' WHEN 2 THEN 'Back soon.'
            WHEN 3 THEN 'Write to info@' || dom || ', ' || f1 || CAST(msg_id AS STRING) || '@yahoo.com or sam.sender@' || dom WHEN 4 THEN 'Your ticket is 99000000' || CAST(msg_id AS STRING) || '@' || dom ELSE 'No one.' END AS raw
        FROM reply_names""",
    "sweep": """
        SELECT email, CASE WHEN id % 2 = 0 THEN 'bounce' ELSE 'ooo' END AS kind, CASE WHEN id % 3 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(id % 20 AS INT) END AS evdate
        FROM contacts WHERE email IS NOT NULL AND id % 17 = 3""",
    "senders": """
        SELECT id AS seq, full_name AS display_name, CASE id % 6 WHEN 0 THEN first_name || '.' || last_name WHEN 1 THEN substr(first_name, 1, 1) || last_name
            WHEN 2 THEN first_name WHEN 3 THEN first_name || last_name WHEN 4 THEN first_name || '_' || last_name ELSE 'desk' END || '@' || email_domain AS address
        FROM contacts WHERE email_domain IS NOT NULL""",
    "locator_raw": """
        SELECT 'brand_' || CAST(s_suppkey % 20 AS STRING) AS brand_slug, s_suppkey AS seq,
          '{"dealer":{"code":"' || CAST(s_suppkey % 60 AS STRING) || '","name":" ' || s_name || ' ","state":"' || r_name || '"},"departments":[{"phone":""},{"phone":"' ||
          CAST(1000 + s_suppkey AS STRING) || '","email":"d' || CAST(s_suppkey AS STRING) || '@a.test"}],"address":"' || CAST(s_suppkey AS STRING) || ' Long Road, Town ' || CAST(s_suppkey % 9 AS STRING) || ', VIC ' || CAST(3000 + s_suppkey % 900 AS STRING) || '"}' AS payload_json
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
}


def needed(text: str) -> list[str]:
    """Tables a query rests on, in an order in which each comes after its own."""
    out: list[str] = []

    def visit(sql: str) -> None:
        for name in TABLES:
            if name not in out and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
                visit(TABLES[name])
                out.append(name)

    visit(text)
    return out


def oracle(sql: str) -> str:
    """DuckDB SQL with the domain tables it needs before it."""
    first = [f"{n} AS ({TABLES[n].replace('AS STRING', 'AS VARCHAR')})" for n in needed(sql)]
    body, word = sql.strip(), "WITH "
    if body.upper().startswith("WITH RECURSIVE "):
        body, word = "WITH " + body[15:], "WITH RECURSIVE "
    if body.upper().startswith("WITH "):
        first, body = [*first, body[5:]], ""
    return (word + ",\n".join(first) + "\n" + body) if first else body


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table, or one of the driver's, as a DataFrame."""
    if name in DRIVER_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names = [*needed(f"FROM {name}")]
    text = " ".join(TABLES[n] for n in names)
    # a file is read by as many tasks as it has row groups, of a million short rows: texts are made behind the shuffle, in all tasks
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt = lambda t: f"/*+ REPARTITION({parts}, {DEALT_BY[t]}) */ " if name in READ_BY_PYTHON and t in DEALT_BY else ""
    base = [f"{t} AS (SELECT {dealt(t)}* FROM parquet.`{sf_dir}/{t}.parquet`)" for t in DRIVER_TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", text)]
    # DATE + days is the same text in both; a timestamp without zone is an instant of UTC
    return spark.sql("WITH " + ",\n".join([*base, *(f"{n} AS ({TABLES[n]})" for n in names)]) + f"\nSELECT * FROM {name}")
