"""Vocabularies. Fixed values, each in the order in which it is tried; all of them are defaults of parameters."""

# Role titles, the first one contained in a title wins.
ROLES = {
    "dealer principal": "Dealer Principal", "dp": "Dealer Principal", "general manager": "General Manager", "gm": "General Manager",
    "sales manager": "Sales Manager", "new car sales manager": "New Car Sales Manager", "used car sales manager": "Used Car Sales Manager",
    "new car manager": "New Car Sales Manager", "used car manager": "Used Car Sales Manager", "service manager": "Service Manager",
    "parts manager": "Parts Manager", "finance manager": "Finance Manager", "finance & insurance manager": "Finance Manager",
    "f&i manager": "Finance Manager", "business manager": "Business Manager", "sales consultant": "Sales Consultant",
    "sales executive": "Sales Executive", "sales advisor": "Sales Advisor", "service advisor": "Service Advisor",
    "service consultant": "Service Advisor", "parts interpreter": "Parts Interpreter", "receptionist": "Receptionist",
}
# Words that make a title plausible.
ROLE_KEYWORDS = [
    "dealer principal", "general manager", "sales manager", "service manager", "parts manager", "finance manager", "business manager",
    "used car manager", "new car manager", "sales consultant", "sales executive", "sales advisor", "service advisor", "service consultant",
    "receptionist", "manager", "director", "consultant", "advisor", "executive", "technician", "controller", "coordinator", "accountant",
    "apprentice", "detailer", "valuator", "estimator", "interpreter", "foreman", "specialist", "analyst", "principal",
]
# Words of titles; an s at a name's end is cut before it is compared.
TITLE_WORDS = [
    "manager", "consultant", "advisor", "executive", "director", "principal", "coordinator", "controller", "specialist", "technician",
    "apprentice", "receptionist", "interpreter", "clerk", "assistant", "accountant", "foreman", "estimator", "valuator", "detailer",
    "analyst", "supervisor", "officer", "team", "department", "admin", "care", "operations", "customer", "fixed", "new", "used",
    "pre-owned", "sales", "service", "parts", "finance", "insurance", "business", "general", "brand", "communications", "delivery",
    "fleet", "wholesale", "digital", "marketing", "senior", "junior", "chief", "head", "lead",
]
# Forms of an address's local part before the @, tried in this order ({f}, {l}: initials).
PREFIXES = ["{first}.{last}", "{f}{last}", "{first}", "{first}{l}", "{last}.{first}", "{last}{f}", "{first}_{last}", "{first}{last}"]
# A shared inbox, as a pattern over a local part.
ROLE_INBOX = (
    r"(^|[._-])(sales|parts|service|servicing|enquir|enquiries|admin|info|information|contact|reception|accounts?|warranty|fleet|general|"
    r"office|reservations?|newvehicles?|usedvehicles?|newcars?|usedcars?|preowned|leads?|bdc|department|dept|workshop|bookings?|aftersales|"
    r"customercare|customerservice|showroom|principal|manager|consultant|coordinator|representative|noreply|no-reply|donotreply)([._-]|$)"
)
# Words that make a local part no person's, anywhere in it.
SHARED_WORDS = (
    r"(?i)(sales|parts|service|enquir|admin|info|contact|dealer|princip|manage|management|team|depart|dept|form|recept|account|warranty|"
    r"finance|fleet|used|general|office|mail|marketing|career|jobs|workshop|booking|aftersales|make|anenquiry|customer|business|"
    r"interpreter|reservation|leads?|bdc)"
)
# Order of (band, tier) in a plan, and the tiers' labels.
BAND_TIERS = [
    ("AU", "T1"), ("COM", "T1"), ("AU", "dealer"), ("COM", "dealer"), ("INTL", "dealer"), ("AU", "T2"), ("COM", "T2"), ("INTL", "T2"),
    ("AU", "T3"), ("COM", "T3"), ("INTL", "T3"), ("AU", "T4"), ("COM", "T4"), ("INTL", "T4"), ("INTL", "T1"),
]
TIER_LABELS = {"T1": "T1", "T2": "T2", "T3": "T3", "T4": "T4", "dealer": "DLR"}
# Mail providers open to anybody.
FREEMAIL = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "live.com", "icloud.com", "aol.com", "mail.com", "protonmail.com",
    "fastmail.com", "zoho.com", "bigpond.com", "bigpond.net.au", "optusnet.com.au", "internode.on.net", "ozemail.com.au",
    "adam.com.au", "tpg.com.au", "dodo.com.au", "westnet.com.au",
]
# Words of domains by tier: makers, importers' domains, bodies' domains, suppliers, agencies.
MAKERS = [
    "mercedes-benz", "mercedes", "daimler", "amg", "jaguarlandrover", "jaguar", "landrover", "bmw", "bmwgroup", "bmwfinance", "mini",
    "rollsroyce", "ford", "lincoln", "stellantis", "fcagroup", "fca", "chrysler", "jeep", "ram", "dodge", "fiat", "alfaromeo", "alfa",
    "abarth", "maserati", "peugeot", "citroen", "ds", "opel", "vauxhall", "mpsa", "suzuki", "polestar", "volvo", "volvocars", "nissan",
    "infiniti", "datsun", "mazda", "renault", "dacia", "audi", "volkswagen", "vw", "vwga", "vwfs", "porsche", "seat", "cupra", "skoda",
    "bentley", "lamborghini", "bugatti", "toyota", "lexus", "hino", "daihatsu", "mitsubishi", "mmal", "mg", "mgmotor", "ldv", "maxus",
    "honda", "hyundai", "genesis", "kia", "tesla", "gwm", "haval", "chery", "omoda", "jaecoo", "byd", "subaru", "isuzu", "iveco", "scania",
    "man", "kenworth", "daf", "fuso", "mack", "volttrucks", "voltatrucks", "ineos", "lotus", "mclaren", "ferrari", "astonmartin",
    "cadillac", "chevrolet", "gmsv", "ora", "deepal", "zeekr", "smart", "leapmotor", "xpeng", "nio", "lucid", "rivian",
]
IMPORTERS = ["inchcape.com.au", "ateco.com.au", "atecoautomotive.com.au", "lsh-auto.com.au", "lshauto.com.au", "eagers.com.au", "apeagers.com.au"]
BODIES = [
    "fcai.com.au", "aada.com.au", "vacc.com.au", "mtaa.com.au", "mtansw.com.au", "mtaq.com.au", "mtasa.com.au", "mtav.com.au", "mia.org.nz",
    "ancap.com.au", "aaaa.com.au", "evc.org.au", "electricvehiclecouncil.com.au", "aaa.asn.au", "carsafety.gov.au", "tmaa.com.au", "vaca.com.au",
]
SUPPLIERS = [
    "cox", "coxautoinc", "bosch", "continental", "bridgestone", "michelin", "goodyear", "dunlop", "denso", "zf", "magna", "valeo", "pirelli",
    "castrol", "penrite", "narva", "redarc", "ryco", "gates", "mann", "mahle", "borgwarner", "aptiv", "hella", "brembo", "sachs", "bilstein",
    "thermoking", "webasto", "acdelco", "repco", "bapcor", "gpc", "supercheap",
]
AGENCIES = [
    "wpp", "wppmedia", "havas", "havasred", "ogilvy", "spark", "sparkfoundry", "sparkfoundryww", "publicis", "omnicom", "edelman", "weber",
    "webershandwick", "hillandknowlton", "hkstrategies", "mccann", "ddb", "tbwa", "saatchi", "dentsu", "mediacom", "mindshare", "initiative",
    "wavemaker", "essencemediacom", "haystac", "influenceassociates", "poem", "thehallway", "howatson", "cummins", "clemenger", "redagency",
    "professionalpublicrelations", "ppr", "keepleft", "sequel", "herd", "articulate", "playpr", "thrive", "liquidideas", "hausmann", "n2n",
    "res", "engagemedia", "sensis", "carat", "zenith", "starcom", "omd", "phd", "um", "iprospect", "merkle", "isobar", "vmlyr", "mpsa",
]
# Words of agencies' domains, whose address formats tell nothing of a client's.
HOUSE_AGENCIES = [
    "ogilvy", "havas", "havasmedia", "omnicom", "omc", "sparkfoundry", "sparkfoundryww", "starcom", "publicis", "wpp", "vmlyr", "mccann",
    "edelman", "webershandwick", "weber", "hillandknowlton", "hkstrategies", "fleishman", "fleishmanhillard", "bcw", "burson", "golin",
    "ketchum", "porternovelli", "cannings", "sefiani", "prcomms", "poemgroup", "thecampaignpalace", "clemenger", "initiative", "mediacom",
    "essencemediacom", "wavemaker", "zenithmedia", "carat", "dentsu", "iprospect", "mindshare", "pitchpr", "keepleft", "haystac", "herdmsl",
    "msl", "n2n", "poem", "connectedcontent",
]
# publishers' domains whose people are never written to.
MEDIA_DOMAINS = [
    "drive.com.au", "carsales.com.au", "carexpert.com.au", "carsauce.com", "carsauce.com.au", "evcentral.com.au", "wheelsmedia.com.au",
    "whichcar.com.au", "carsguide.com.au", "caradvice.com.au", "motoring.com.au", "carscoops.com", "thedriven.io", "goauto.com.au",
    "redriven.com.au", "news.com.au",
]
# What a mail exchanger's name tells, tried in this order.
GATEWAYS = {
    "google": "Google", "googlemail": "Google", "outlook": "Microsoft365", "microsoft": "Microsoft365", "office365": "Microsoft365",
    "mimecast": "Mimecast", "pphosted": "Proofpoint", "proofpoint": "Proofpoint", "messagelabs": "Symantec", "symantec": "Symantec",
}
SMALL_HOSTS = ["cpanel", "websitewelcome", "hostinger", "mxrouting"]
# Local parts of shared inboxes when addresses are verified.
VERIFY_ROLES = [
    "info", "sales", "admin", "office", "contact", "enquiries", "enquiry", "hello", "support", "marketing", "media", "press", "reception",
    "accounts", "service", "help", "team", "mail", "noreply", "no-reply",
]
# Local parts of shared inboxes in mail, and words that make a name no person's.
MAIL_ROLES = [
    "noreply", "no-reply", "donotreply", "do-not-reply", "postmaster", "mailer-daemon", "mailerdaemon", "abuse", "bounce", "bounces", "info",
    "sales", "service", "parts", "admin", "administration", "accounts", "account", "enquiries", "enquiry", "inquiries", "inquiry", "reception",
    "contact", "support", "marketing", "careers", "jobs", "hr", "fleet", "warranty", "bookings", "booking", "newsletter", "feedback", "office",
    "mail", "team", "help", "hello", "general", "customerservice", "customercare", "webmaster", "notifications",
]
NOT_NAMES = [
    "manager", "director", "officer", "chief", "executive", "consultant", "advisor", "adviser", "principal", "coordinator", "president",
    "head", "specialist", "representative", "associate", "supervisor", "lead", "group", "pty", "ltd", "limited", "holdings", "motors",
    "motor", "automotive", "australia", "australian", "africa", "news", "media", "finance", "insurance", "marketing", "sales", "service",
    "team", "department", "company", "corporation", "dealership", "dealer", "national", "global", "international", "region", "regional",
    "partners", "solutions", "services", "enterprises",
]
# Words that make a name in a release no person's.
RELEASE_NOT_NAMES = [
    "australia", "australian", "pty", "ltd", "limited", "group", "holdings", "inc", "corp", "corporation", "company", "co", "motors",
    "motor", "automotive", "consulting", "partners", "solutions", "services", "enterprises", "ogilvy", "communications", "communication",
    "manager", "director", "officer", "chief", "executive", "consultant", "advisor", "adviser", "principal", "coordinator", "president",
    "head", "specialist", "representative", "associate", "supervisor", "lead", "relations", "public", "product", "external", "corporate",
    "affairs", "media", "press", "marketing", "sales", "service", "finance", "insurance", "newsroom", "department", "division", "office",
    "team", "mobile", "telephone", "phone", "email", "enquiries", "enquiry", "contact", "contacts", "national", "global",
    "international", "region", "regional",
]
# Local parts that are no person's on web pages, whole and as patterns; domains of the web's own plumbing.
GENERIC_LOCALS = [
    "info", "sales", "service", "parts", "admin", "reception", "enquiries", "contact", "noreply", "no-reply", "accounts", "marketing",
    "support", "hello", "enquiry", "booking", "bookings", "general", "finance", "warranty", "body", "newcars", "usedcars", "tradein",
    "testdrive", "fleet", "corporate", "wholesale", "careers", "jobs", "hr", "recruitment", "workshop", "bodyshop", "panel", "detailing",
    "digital", "web", "internet", "online", "fixed", "aftermarket", "events", "feedback", "complaints", "demo", "delivery", "predelivery",
    "manager", "dealer", "dealership",
]
GENERIC_PATTERNS = [
    r"^(service|parts|sales|admin|reception|enquir|contact|info|booking)", r"^(new|used)cars?", r"^(trade|test)", r"^fleet", r"^corporate",
    r"^wholesale", r"^(career|job|recruit|hiring)", r"^(workshop|bodyshop|body-shop|panel)", r"^(digital|web|internet|online)",
    r"^(event|feedback|complaint)", r"^(demo|deliver)",
    r"(mazda|toyota|hyundai|nissan|subaru|bmw|audi|volvo|ford|kia)$",
    r"(honda|isuzu|mitsubishi|mercedes|volkswagen|ldv|mg|byd|gwm|jeep)$",
    r"(service|parts|sales)(mazda|toyota|hyundai|nissan|subaru|bmw|ford|kia)",
    r"(mazda|toyota|hyundai|nissan|subaru|bmw|ford|kia)(service|parts|sales)",
]
INFRASTRUCTURE = [
    "google.com", "gmail.com", "facebook.com", "twitter.com", "instagram.com", "youtube.com", "linkedin.com", "gravatar.com",
    "wordpress.com", "wpengine.com", "schema.org", "w3.org", "cloudflare.com", "sentry.io", "example.com", "test.com", "localhost",
    "googleusercontent.com", "gstatic.com", "apple.com", "microsoft.com", "outlook.com", "hotmail.com", "yahoo.com", "aol.com",
    "mailchimp.com", "sendgrid.net", "amazonaws.com", "zendesk.com", "intercom.io", "hubspot.com", "salesforce.com", "marketo.com",
    "wixsite.com", "squarespace.com", "shopify.com",
]
# Paths, words and endings of links to pages about people; classes of elements about one person.
TEAM_PATHS = [
    "/our-team", "/meet-the-team", "/meet-our-team", "/the-team", "/team", "/staff", "/people", "/about-us/team", "/about-us/our-team",
    "/about-us/staff", "/about/team", "/about/our-team", "/about/staff",
]
TEAM_WORDS = ["our team", "meet the team", "meet our team", "the team", "our staff", "our people", "team members"]
NOT_PAGES = [".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".css", ".js"]
CARD_CLASSES = [
    "team", "staff", "member", "person", "profile", "card", "employee", "bio", "personnel", "crew", "people", "leadership", "management",
    "et_pb_team_member", "author", "avatar", "headshot",
]
# Labels of departments and pages that were taken for names, as patterns.
DEPARTMENTS = [
    r"^(new|used|pre[- ]?owned|certified|premium)\s+(car\s+)?sales?$", r"^(sales|service|parts|finance|fleet|admin|workshop)\s+(team|department)$",
    r"^(service|parts)\s*[&+]\s*(parts|bodyshop|accessories|service)$", r"^finance[,\s]*(insurance|aftercare|car care)",
    r"^customer\s+(relations|experience|care|service)$", r"^(the|our|meet the)\s+team$", r"^enquiry\s+(form|now)$",
    r"^contact\s+(us|form|dealer)$", r"^(friendly|our|meet our)\s+staff$",
]
LABELS = [
    "new and used sales", "pre owned sales", "pre-owned sales", "premium used cars", "certified pre-owned", "new car sales", "used car sales",
    "customer relations", "customer experience", "customer care", "the team", "our team", "meet the team", "team", "service & parts",
    "service & bodyshop", "service and parts", "parts & accessories", "parts and accessories", "finance, insurance & aftercare",
    "finance & insurance", "finance, insurance & car care", "finance and insurance", "sales department", "service department",
    "parts department", "sales team", "service team", "parts team", "admin team", "workshop", "bodyshop", "body shop", "fleet sales",
    "fleet department", "wholesale", "wholesale department", "enquiry form", "contact us", "contact form", "get in touch", "friendly staff",
    "our staff", "meet our staff", "sales manager", "service manager", "parts manager", "finance manager", "business manager",
    "general manager", "dealer principal", "sales consultant", "sales executive", "sales advisor", "service advisor", "service consultant",
    "parts interpreter", "receptionist", "graphic designer", "marketing coordinator", "account manager", "brand manager", "digital manager",
    "marketing manager", "operations manager", "administration manager", "administration clerk", "administrative assistant",
    "assistant accountant", "assistant sales manager", "assistant service manager", "brand and communications manager",
    "marketing and e-commerce coordinator", "fixed operations manager",
]
# Subjects and senders of undelivered mail, where the failed address stands, subjects of absence notes.
NDR_SUBJECT = r"(?i)undeliverable|mail delivery (failed|subsystem)|delivery status notification|returned mail|failure notice|delivery has failed|could not be delivered"
NDR_FROM = r"(?i)mailer-daemon|postmaster@|microsoft outlook|mail delivery"
FAILED = r"(?i)(?:Final-Recipient|Original-Recipient|X-Failed-Recipients)\s*:\s*(?:rfc822\s*;\s*)?([A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+)"
AWAY_SUBJECT = r"(?i)automatic reply|out of office|auto[\s\-]?reply|autoreply|on leave|away from the office|annual leave|currently out"
ADDRESS = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

# Names that are none, of two words or more (one word is never a name).
SKIP_NAMES = [
    "our team", "meet the team", "meet our team", "about us", "hatch & sedans", "electric & hybrids", "suvs & crossovers",
    "book a service", "take a test drive", "trading hours", "quick enquiry", "get a quote", "find a dealer", "request a quote",
    "build and price", "peace of mind", "customer care", "roadside assist", "genuine parts", "genuine accessories",
]
# Models of two words or more that don't start with a digit.
MODEL_NAMES = ["grand cherokee", "ioniq 5", "ioniq 5 n", "ioniq 5 n line", "ioniq 6", "ioniq 9", "santa fe", "sonata n line", "i30 n"]
# Makes at the start of a vehicle's name, and at the end of a dealer's.
MAKES_FIRST = [
    "mazda", "toyota", "hyundai", "nissan", "subaru", "kia", "ford", "isuzu", "bmw", "mercedes", "volkswagen", "audi", "volvo", "jeep",
    "honda", "mitsubishi", "ldv", "mg", "byd", "gwm", "mini", "renault", "suzuki", "omoda", "jaecoo",
]
MAKES_LAST = [
    "jeep", "bmw", "audi", "volvo", "ford", "kia", "mazda", "nissan", "toyota", "hyundai", "honda", "subaru", "isuzu", "mitsubishi",
    "volkswagen", "mercedes", "ldv", "mg", "byd", "gwm", "mini", "renault", "suzuki",
]
# Other words of vehicles, as patterns.
VEHICLE_WORDS = [
    r"^all[- ]new\b", r"^new\s+\w+\s+(mx|cx|bt|cr|hr|rav|hilux|ranger)", r"\b(suv|sedan|hatch|hatchback|ute|utes|van|vans|wagon|coupe|cab|convertible)\b",
    r"\b(suvs|sedans|hatches|coupes|wagons|convertibles)\b", r"\b(cx-\d|mx-\d|bt-\d|cr-v|hr-v|rav4|corolla|camry|hilux|ranger)\b", r"\bseats?\b", r"\bcab\b",
    r"\bhybrid\b", r"\belectric\b", r"\bev\b", r"\bphev\b", r"^(new|used|demo)\s+(car|vehicle)",
]
# Words of a client's name that don't tell whose it is, and ends of domains.
CLIENT_STOPS = [
    "australia", "australian", "pty", "ltd", "limited", "group", "motors", "motor", "automotive", "cars", "car", "company", "co", "inc",
    "corp", "corporation", "holdings", "the", "and", "of", "new", "zealand", "anz",
]
DOMAIN_ENDS = ["com", "au", "net", "org", "co", "nz"]
# Shared inboxes of press offices, beside those of mail.
PRESS_ROLES = [
    "media", "pr", "press", "comms", "communications", "communication", "newsroom", "publicrelations", "mediarelations",
    "corporateaffairs", "prteam", "mediateam", "pressoffice", "media.relations",
]
# Fixed value: what heads a table of contacts.
CONTACT_HEADER = r"(?i)\b(contacts?|media enqu|media contact|further information|press (?:contact|office))\b"
# Fixed value: a name and a role in running text.
NAME_AND_ROLE = r"([A-Z][a-z]+ [A-Z][a-z]+)\s*[-–|]\s*(.{5,40})"
# Fixed value: a name before an address.
NAME_NEAR = r"\b([A-Z][a-z]+(?:['\-][A-Z][a-z]+)?(?: [A-Z][a-z]+){1,2})\b"
# What tells of an appointment, and the sentences that name who is appointed (group 1) and as what (group 2), in order.
APPOINTING = r"(?iU)\b(appoint\w*|joins|joining|named|welcomes|welcomed|promot\w*|new (?:chief|head|director|manager|general manager|ceo|md|managing director)|steps? (?:up|into)|takes? (?:up|over|the reins)|succeeds?)\b"
APPOINTED = [
    r"(?U)(?:has |have )?appointed\s+([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})(?:\s+(?:as|to)\s+(?:its |the |a |an )?([^.,;()\n]{3,60}))?",
    r"(?U)([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})\s+has been appointed(?:\s+(?:as|to)\s+)?(?:its |the |a |an )?([^.,;()\n]{3,60})?",
    r"(?U)([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})\s+(?:has |will )?join(?:s|ed|ing)?\b[^.,;\n]{0,40}?\s+as\s+(?:its |the |a |an )?([^.,;()\n]{3,60})",
    r"(?U)(?:the )?appointment of\s+([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})(?:\s+(?:as|to)\s+(?:its |the |a |an )?([^.,;()\n]{3,60}))?",
    r"(?U)([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})\s+has been named(?:\s+(?:as|to)\s+)?(?:its |the |a |an )?([^.,;()\n]{3,60})?",
    r"(?U)(?:welcomes?|welcomed)\s+([A-Z][a-zA-Z'\-]+(?: [A-Z][a-zA-Z'\-]+){1,2})(?:\s+(?:as|to)\s+(?:its |the |a |an )?([^.,;()\n]{3,60}))?",
]
#: What a text must hold for the sentence in the same place above to match.
APPOINTED_WORDS = ["appointed", "has been appointed", "join", "appointment of", "has been named", "welcome"]
# Fields of a release in which its date may stand, in order.
DATE_FIELDS = ["published_at", "publishedAt", "release_date", "releaseDate", "date", "created_at", "createdAt", "publish_date", "live_date"]
