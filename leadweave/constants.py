"""Fixed values of the contact pipeline. Each must equal these for right results; order matters where stated."""

# The pattern of one e-mail address, of an obfuscated address attribute and of an absolute link.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CF_ATTRIBUTE = r'data-cfemail="([0-9a-fA-F]+)"'
HREF = r"""href=["'](https?://[^"'>\s]+)"""

# Texts that stand for "no site".
PLACEHOLDERS = ("-", "n/a", "none")

# Contact pages in the order in which they are tried; the verifier uses the first ten.
CONTACT_PATHS = (
    "", "/contact", "/contact.html", "/contactformulier", "/contact-us", "/kontakt", "/kontakt.html", "/impressum",
    "/imprint", "/iletisim", "/over-ons", "/about", "/about-us", "/ueber-uns", "/team", "/vacatures", "/careers",
    "/karriere", "/jobs",
)

# An address that contains one of these isn't a contact address.
JUNK_SUBSTRINGS = (
    "sentry.io", "wixpress", "example.", "domain.com", "yourdomain", "@2x.", ".png", ".jpg", ".jpeg", ".gif", ".svg",
    ".webp", ".css", ".js", "u003e", "email@", "your@", "name@", "test@", "abc@", "xxx@",
)

# Local parts that nobody reads.
JUNK_LOCALS = ("noreply", "no-reply", "donotreply", "postmaster", "abuse", "webmaster", "hostmaster", "privacy", "dpo", "avg", "gdpr")

# Hosts of platforms, neither a firm's own host nor the host of its address.
JUNK_HOSTS = (
    "sentry.io", "wordpress.com", "wix.com", "jouwweb.nl", "squarespace.com", "godaddy.com", "cloudflare.com",
    "google.com", "gmail.example", "shopify.com", "webflow.com", "strato.de", "ionos.de", "hostnet.nl",
)

# Mail providers shared by many firms.
FREEMAIL = (
    "gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "gmx.de", "gmx.net", "web.de", "t-online.de", "hetnet.nl",
    "ziggo.nl", "live.nl", "kpnmail.nl", "planet.nl", "icloud.com",
)

# Local parts that rank first.
PRIORITY_LOCALS = ("info", "contact", "kontakt", "office", "mail", "kantoor", "administratie", "bewerbung", "career", "jobs", "hr")

# Hosts with one of these are social or search sites.
SOCIAL = ("facebook", "twitter", "linkedin", "instagram", "youtube", "google", "wikipedia", "x.com")

# Office types of the area scan; the batch scan adds the last two.
OFFICE_TYPES = ("accountant", "tax_advisor", "financial", "employment_agency")
BATCH_OFFICE_TYPES = ("accountant", "tax_advisor", "financial", "financial_advisor", "employment_agency", "consulting")

# Country of old campaign tags.
LEGACY_TAGS = {
    "1-TURK": "NL", "1-TURK-RISKLI": "NL", "2-EN": "NL", "3-NL": "NL", "DE-EN": "DE", "DE-TURK": "DE",
    "GULF-EN": "AE", "GULF-TURK": "AE",
}

# Country names of verified lists.
COUNTRY_CODES = {
    "Estonia": "EE", "Latvia": "LV", "Lithuania": "LT", "Bulgaria": "BG", "Romania": "RO", "Czech Republic": "CZ",
    "Slovakia": "SK", "Hungary": "HU", "Croatia": "HR", "Slovenia": "SI", "Portugal": "PT", "Spain": "ES",
    "Italy": "IT", "Greece": "GR", "Malta": "MT", "Sweden": "SE", "Finland": "FI", "Luxembourg": "LU",
    "Belgium": "BE", "Thailand": "TH", "Vietnam": "VN", "Global": "EU",
}
