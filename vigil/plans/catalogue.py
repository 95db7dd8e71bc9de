"""Catalogues that the queries are given: invented entities, brands, sectors and address ranges."""

#: (idx, entity, domains)
ENTITIES = [
    (0, "Therin Bank", ["therin.example.net", "therin-bank.com"]),
    (1, "Ththre Pay (TTP)", ["ththre.example.com", "ttp.co.in"]),
    (2, "Thther Telecom", ["thther.example.org"]),
    (3, "Spam Farm Watch", ["spam-farm.example.org", "spamfarm.net"]),
    (4, "Onti Air", ["onti.example.com", "example.org"]),
    (5, "Red Widget (RW)", ["widget.example.net", "redwidget.com"]),
]
#: Entities, as above, and hosts of the gate's known cases.
PROTECTED = [
    (0, "Axis Bank", ["axisbank.com", "axismf.com", "axismaxlife.com"]),
    (1, "Airtel", ["airtel.in", "airtel.com"]),
    (2, "Kfintech", ["kfintech.com"]),
    (3, "Air India", ["airindia.com", "airindiaexpress.com"]),
    (4, "Computer Age Management Services Ltd. (CAMS)", ["camsonline.com"]),
    (5, "State Bank of India (SBI)", ["sbi.co.in", "onlinesbi.com"]),
    (6, "ICICI Bank", ["icicibank.com"]),
    (7, "Registrar General and Census Commissioner of India (RGCCI)", ["crsorgi.gov.in"]),
    (8, "UIDAI", ["uidai.gov.in"]),
]
JUDGED = (
    "16fintech.com", "airtelbox.com", "airtiz.net", "ajiraexpress.com", "art-axis.art", "atmosonline.com", "axis-fluxrad.com", "axis-grandhiraki.com", "axis-mobfintech.com", "axis-modelmgmt.com",
    "airtel-secure-pay.club", "axisupi-login.com", "sbirewardlogin.com", "icici-bank-secure.icu", "crsorgi-login.info", "uidai-service-gov.com", "5208is.xyz", "axis-network.com", "home-loans.website",
)
#: (alias, canonical)
BRANDS = [("license", "GNU"), ("gnu", "GNU"), ("public", "GNU"), ("the", "Article"), ("and", "Article"), ("der", "Artikel"), ("und", "Artikel"), ("token", "Secret"), ("que", "Articulo")]
#: (token, sector); the first that matches
SECTORS = [("promo", "Retail"), ("ring", "Jewellery"), ("widget", "Industry"), ("economy", "Budget"), ("large", "Freight"), ("medium", "General")]
#: (low, high, asn, country)
GEO = [(0, 9_999, "AS1", "AA"), (10_000, 65_535, "AS2", "BB"), (65_536, 99_999, "AS3", "CC"), (120_000, 140_000, "AS4", "DD")]
SALE_RULES = ["work is licensed", "this domain is for sale"]
#: (exception, message)
FAILED = [
    ("TimeoutError", "Page.goto: Timeout 30000ms exceeded.\nCall log:\n  - navigating\n  - waiting\n  - more\n  - last"), ("Error", "net::ERR_CONNECTION_RESET at https://x.org/"), ("Error", "net::ERR_SSL_PROTOCOL_ERROR"), ("TargetClosedError", "gone"),
    ("NXDOMAIN", "The DNS query name does not exist: x.org."), ("NoAnswer", "no answer"), ("LifetimeTimeout", "The resolution lifetime expired"), ("OSError", "[Errno 104] Connection reset by peer"), ("ClientError", "429 too many requests"),
    ("ClientError", "503 Service Unavailable\nBrowser logs:\nmuch"), ("ValueError", ""), ("ValueError", "boom"), ("gaierror", "Temporary failure in name resolution"),
]
#: Registration documents.
REGISTRATIONS = [
    "{}",
    '{"events": [{"eventAction": "expiration", "eventDate": "2031-01-01"}, {"eventAction": "registration", "eventDate": "2020-02-03"}], "nameservers": [{"ldhName": "NS1.X.ORG"}, {"ldhName": ""}, {"ldhName": "ns2.x.org"}]}',
    '{"entities": [{"roles": ["abuse"], "vcardArray": ["vcard", [["version", {}, "text", "4.0"], ["org", {}, "text", "ORG"]]]}, {"roles": ["registrant"], "vcardArray": ["vcard", [["fn", {}, "text", "Jo Doe"], ["adr", {}, "text", ["", "", "S", "T", "", "1", "IN"]]]]}]}',
    '{"entities": [{"roles": ["registrar", "tech"], "vcardArray": ["vcard", [["fn", {}, "text", "Names Inc"]]], "entities": [{"roles": ["registrant"], "vcardArray": ["vcard", [["fn", {}, "text", "Nested Owner"]]]}]}]}',
    '{"entities": [{"roles": ["registrant"], "vcardArray": ["vcard", [["fn", {}, "text", "Own"], ["adr", {"cc": "x"}, "text", {"country-name": "France"}]]]}, {"roles": ["registrar"], "vcardArray": ["vcard", [["org", {}, "text", "no name"]]]}]}',
    "not json",
]
#: (hash, other hash, references)
HASHES = [
    ("ffffffffffffffff", "ffffffffffffffff", ["ffffffffffffffff"]), ("ffffffffffffffff", "0000000000000000", ["0000000000000000"]), ("0xFFFFffffffffffff", "fffffffffffffff0", ["zz", "0xfffffffffffffffe"]), ("ff", "0x0F", ["", "1"]), ("zz", "00", ["00"]),
    ("", "00", ["00"]), ("0f0f0f0f0f0f0f0f", "f0f0f0f0f0f0f0f0", []), (None, "00", ["00"]), (" ABCDEF0123456789 ", "abcdef0123456780", ["abcdef0123456700", "abcdef0123456788"]),
]
#: (subject, issuer, names)
CERTIFICATES = [
    ([("commonName", " Bank.Example "), ("organizationName", "Bank Ltd")], [("commonName", "CA 1"), ("organizationName", "Trust")], [("DNS", "www.bank.example"), ("dns", "Bank.example"), ("IP", "10.0.0.1"), ("DNS", "bank.example")]),
    ([], [("organizationName", "Trust"), ("organizationName", "A Trust")], []),
    ([], [], []),
]
#: (brand, aliases, aliases that prove something, domains)
BRAND_TABLE = [
    ("axis", ["axis", "Axis Bank", "axis upi"], ["axis bank", "axis upi", "axis"], ["axisbank.com"]),
    ("airtel", ["airtel", "bharti airtel"], ["airtel", "bharti airtel"], ["airtel.in", "airtel.com"]),
    ("sbi", ["sbi", "state bank of india"], ["sbi", "state bank of india"], ["sbi.co.in", "onlinesbi.com"]),
]
#: (domain, header, recognised text, page text, entity, its domain)
SHOWN = [
    ("evil.com", "Welcome to Axis-Bank", "", "", "Axis Bank", "axisbank.com"), ("axisbank.com", "Axis Bank", "", "", "", ""), ("x.axisbank.com", "", "axis bank", "", "Axis Bank", ""), ("evil.com", "axis", "", "", "", ""),
    ("evil.com", "", "", "State Bank of India", "", ""), ("evil.com", "Airtel", "Axis Bank", "", "Axis Bank", ""), ("evil.com", "nothing here", "", "", "", ""), ("evil.org", "", "stateBANK of India and airtel", "", "Unknown", "m.sbi.co.in"),
]
#: (word, sector), by word; words of more than one sector don't occur.
SECTOR_RULES = [("sbi", "Banking/Financial"), ("card", "Banking/Financial"), ("life", "Insurance"), ("gov", "Government"), ("nic", "Government"), ("irctc", "Transport"), ("rail", "Transport"), ("airtel", "Telecom"), ("oil", "Oil & Gas")]
#: (entity, domain, registrar, hoster, records)
ORGANISATIONS = [
    ("Indian Railway (IRCTC)", "irctc.co.in", "GoDaddy LLC", "x", "ssl"), ("Oil India", "oil.gov.in", "NA", "na", ""), ("SBI Card", "sbicard.com", "", "Cloudflare", "TLS 1.3"), ("Life Corp", "licindia.in", "CheapNames", "", ""), ("Nobody", "airtelworld.net", "x", "y", ""), (None, "plain.org", "x", "BulletProof host", ""),
    ("State ICICI", "icici.example", "godaddy", "", ""),
]
