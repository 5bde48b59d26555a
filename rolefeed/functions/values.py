"""Fixed values that must equal the reference's for equal results.

They are stated here plainly, in their natural order, and turned into
Column expressions or small broadcast dimension tables elsewhere.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# Feed registry (feed -> hosts, where the slug lives, API host).
# ---------------------------------------------------------------------------
REGISTRY = [
    # (ats, hosts, slug_in, api_host)
    ("greenhouse", ("boards.greenhouse.io", "job-boards.greenhouse.io"), "path", "boards-api.greenhouse.io"),
    ("lever", ("jobs.lever.co",), "path", "api.lever.co"),
    ("ashby", ("jobs.ashbyhq.com",), "path", "api.ashbyhq.com"),
    ("smartrecruiters", ("jobs.smartrecruiters.com",), "path", "api.smartrecruiters.com"),
    ("workable", ("apply.workable.com",), "path", "apply.workable.com"),
    ("rippling", ("ats.rippling.com",), "path", "api.rippling.com"),
    ("breezy", ("breezy.hr",), "subdomain", None),
    ("recruitee", ("recruitee.com",), "subdomain", None),
    ("teamtailor", ("teamtailor.com",), "subdomain", None),
    ("bamboohr", ("bamboohr.com",), "subdomain", None),
    ("jazzhr", ("applytojob.com",), "subdomain", None),
    ("jobvite", ("jobs.jobvite.com",), "path", "jobs.jobvite.com"),
    ("workday", ("myworkdayjobs.com",), "subdomain", None),
]
POLLABLE = tuple(r[0] for r in REGISTRY)

# ---------------------------------------------------------------------------
# Discovery domains in priority order (first match wins).
# ---------------------------------------------------------------------------
SEED_DOMAINS = [
    ("boards.greenhouse.io", "greenhouse", "path"),
    ("job-boards.greenhouse.io", "greenhouse", "path"),
    ("jobs.lever.co", "lever", "path"),
    ("jobs.ashbyhq.com", "ashby", "path"),
    ("jobs.smartrecruiters.com", "smartrecruiters", "path"),
    ("apply.workable.com", "workable", "path"),
    ("jobs.jobvite.com", "jobvite", "path"),
    ("ats.rippling.com", "rippling", "path"),
    ("myworkdayjobs.com", "workday", "subdomain"),
    ("teamtailor.com", "teamtailor", "subdomain"),
    ("bamboohr.com", "bamboohr", "subdomain"),
    ("breezy.hr", "breezy", "subdomain"),
    ("recruitee.com", "recruitee", "subdomain"),
    ("applytojob.com", "jazzhr", "subdomain"),
]

# Labels that are never a company slug.
GENERIC_LABELS = [
    "www", "careers", "career", "jobs", "job", "apply", "app", "api", "help",
    "support", "info", "blog", "status", "go", "my", "secure", "hire", "talent",
    "work", "embed", "boards", "static", "cdn", "assets",
]
# Workday path segments that are never a career-site name.
WORKDAY_NOT_SITE = ["wday", "job", "jobs", "login", "search"]
WORKDAY_LOCALE = r"^[a-zA-Z]{2}(-[A-Za-z]{2})?$"

# Search-capture field slices (seed query plan).
FIELD_TERMS = [
    "software engineer", "data", "machine learning", "artificial intelligence",
    "computer science", "cybersecurity",
    "mechanical engineering", "electrical engineering", "aerospace",
    "chemical engineering", "civil engineering", "biomedical engineering",
    "materials science", "robotics", "hardware", "automotive", "manufacturing",
    "physics", "chemistry", "biology", "biotech", "neuroscience", "research scientist",
    "medical device", "clinical", "pharmaceutical",
    "quantitative", "finance", "accounting", "economics", "investment banking",
    "actuarial", "consulting", "operations", "supply chain", "business development",
    "marketing", "communications", "sales", "product manager", "product designer",
]

# Workday search terms, in request order.
WORKDAY_TERMS = ["intern", "co-op", "new grad", "early career"]

# ---------------------------------------------------------------------------
# Gate rules. HARD reads the title only; FIELD reads
# title + ' ' + description. Patterns are Python/Java compatible.
# ---------------------------------------------------------------------------
HARD_RULES = [
    ("intern", r"\bintern(ship)?s?\b"),
    ("co-op", r"\bco[\s-]?ops?\b"),
    ("new grad", r"\bnew[\s-]?grad(uate)?s?\b"),
    ("early career", r"\bearly[\s-]?career\b"),
]
INTERN_TYPE = r"\bintern"

FIELD_RULES = [
    ("software", r"\bsoftware\b"),
    ("developer", r"\bdevelop(er|ment)?\b"),
    ("AI", r"\b(ai|artificial intelligence)\b"),
    ("ML", r"\b(ml|machine learning)\b"),
    ("data", r"\bdata\b"),
    ("computer science", r"\bcomputer science\b"),
    ("security", r"\b(cyber\s?security|infosec)\b"),
    ("cloud", r"\b(cloud|devops|sre)\b"),
    ("engineering", r"\bengineer(ing|s)?\b"),
    ("mechanical", r"\bmechanical\b"),
    ("electrical", r"\belectrical\b"),
    ("aerospace", r"\b(aerospace|aeronautical|astronautical|avionics)\b"),
    ("chemical eng", r"\bchemical engineer"),
    ("civil", r"\bcivil engineer"),
    ("biomedical", r"\b(biomedical|bioengineer(ing)?|biomechanical)\b"),
    ("robotics", r"\b(robotics?|mechatronics)\b"),
    ("hardware", r"\b(hardware|firmware|embedded|fpga|asic)\b"),
    ("industrial", r"\b(industrial|manufacturing)\b"),
    ("automotive", r"\bautomotive\b"),
    ("controls", r"\bcontrol(s| systems?) engineer"),
    ("materials science", r"\bmaterials scien(ce|tist)\b"),
    ("physics", r"\bphysics?\b"),
    ("chemistry", r"\b(chemistry|chemist)\b"),
    ("biology", r"\b(biology|biologist|molecular|genomics?|genetics)\b"),
    ("biotech", r"\b(biotech(nology)?|bioinformatics|life sciences?)\b"),
    ("neuroscience", r"\bneuroscience\b"),
    ("research", r"\bresearch\b"),
    ("laboratory", r"\blab(oratory)?\b"),
    ("medical", r"\b(medical|medicine|clinical|health\s?care|pharmaceutical|pharma)\b"),
    ("finance", r"\b(finance|financial)\b"),
    ("quant", r"\b(quant|quantitative)\b"),
    ("accounting", r"\b(accounting|accountant|audit(ing)?|taxation)\b"),
    ("economics", r"\b(economics?|econometrics)\b"),
    ("investment", r"\b(investment|banking|trading|trader|private equity|asset management)\b"),
    ("actuarial", r"\bactuar(ial|y)\b"),
    ("consulting", r"\bconsult(ing|ant)\b"),
    ("business", r"\b(business|operations|strategy)\b"),
    ("supply chain", r"\b(supply chain|logistics|procurement)\b"),
    ("analytics", r"\b(analytics|analyst|statistics|statistical)\b"),
    ("mathematics", r"\bmathematic(s|al)\b"),
    ("marketing", r"\bmarketing\b"),
    ("communications", r"\bcommunications\b"),
    ("advertising", r"\b(advertising|public relations|branding)\b"),
    ("product", r"\bproduct manage(r|ment)\b"),
    ("design", r"\b(design(er)?|ux|ui)\b"),
    ("sales", r"\b(sales|business development)\b"),
]

# Strong unpaid signals (bare "unpaid" does not count).
UNPAID_PATTERN = (
    r"\bunpaid\s+(intern(ship)?s?|co-?ops?|positions?|roles?|opportunit(y|ies)|placements?)\b"
    r"|\b(intern(ship)?s?|positions?|roles?)\s+(is|are)\s+unpaid\b"
    r"|\bno\s+(compensation|monetary compensation|salary)\b"
    r"|\bwithout\s+(compensation|pay)\b"
    r"|\b(for|academic|course)\s+credit\s+only\b"
    r"|\bvolunteer\s+(intern(ship)?|position|role|opportunity)\b"
)
UNPAID = "Unpaid"

# Relative post date on workday lists.
WORKDAY_POSTED = r"posted\s+(today|yesterday|([0-9]+)\s+days?\s+ago)"

# Workday URLs inside raw capture text.
WORKDAY_URL = r'https://[a-z0-9-]+\.wd\d+\.myworkdayjobs\.com/[^\s"\\,]*'

# ---------------------------------------------------------------------------
# Country lookup tables.
# ---------------------------------------------------------------------------
ISO2 = {
    "us": "United States", "usa": "United States",
    "gb": "United Kingdom", "uk": "United Kingdom",
    "ca": "Canada", "au": "Australia", "nz": "New Zealand",
    "de": "Germany", "fr": "France", "es": "Spain", "it": "Italy",
    "ie": "Ireland", "nl": "Netherlands", "be": "Belgium", "ch": "Switzerland",
    "at": "Austria", "se": "Sweden", "no": "Norway", "dk": "Denmark",
    "fi": "Finland", "pl": "Poland", "pt": "Portugal", "cz": "Czechia",
    "ro": "Romania", "gr": "Greece", "hu": "Hungary",
    "in": "India", "sg": "Singapore", "jp": "Japan", "kr": "South Korea",
    "cn": "China", "hk": "Hong Kong", "tw": "Taiwan", "my": "Malaysia",
    "ph": "Philippines", "id": "Indonesia", "th": "Thailand", "vn": "Vietnam",
    "il": "Israel", "ae": "United Arab Emirates", "sa": "Saudi Arabia",
    "za": "South Africa", "ng": "Nigeria", "ke": "Kenya", "eg": "Egypt",
    "br": "Brazil", "mx": "Mexico", "ar": "Argentina", "cl": "Chile",
    "co": "Colombia",
    "lv": "Latvia", "lt": "Lithuania", "ee": "Estonia", "hr": "Croatia",
    "si": "Slovenia", "sk": "Slovakia", "rs": "Serbia", "tr": "Turkey",
    "ua": "Ukraine", "bg": "Bulgaria",
}
ALIASES = {
    "united states of america": "United States", "america": "United States",
    "u.s.": "United States", "u.s.a.": "United States", "us of a": "United States",
    "great britain": "United Kingdom", "britain": "United Kingdom",
    "england": "United Kingdom", "scotland": "United Kingdom",
    "wales": "United Kingdom", "u.k.": "United Kingdom",
    "uae": "United Arab Emirates", "korea": "South Korea",
    "czech republic": "Czechia", "cesko": "Czechia", "česko": "Czechia",
    "nederland": "Netherlands", "the netherlands": "Netherlands",
    "deutschland": "Germany", "allemagne": "Germany", "duitsland": "Germany",
    "frankrijk": "France", "frankreich": "France", "francia": "France",
    "brasil": "Brazil",
    "italia": "Italy", "italie": "Italy", "italien": "Italy",
    "belgique": "Belgium", "belgië": "Belgium", "belgie": "Belgium", "belgien": "Belgium",
    "schweiz": "Switzerland", "suisse": "Switzerland", "svizzera": "Switzerland",
    "españa": "Spain", "espana": "Spain", "espagne": "Spain", "spanien": "Spain",
    "österreich": "Austria", "osterreich": "Austria", "autriche": "Austria",
    "danmark": "Denmark", "sverige": "Sweden", "norge": "Norway", "suomi": "Finland",
    "polska": "Poland", "singapour": "Singapore",
    "latvija": "Latvia", "lietuva": "Lithuania", "eesti": "Estonia",
    "hrvatska": "Croatia", "slovensko": "Slovakia", "slovenija": "Slovenia",
    "srbija": "Serbia", "türkiye": "Turkey", "turkiye": "Turkey",
    "magyarország": "Hungary", "magyarorszag": "Hungary", "éire": "Ireland",
}
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
    "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT",
    "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR",
]
NON_COUNTRY = [
    "remote", "null", "none", "n/a", "na", "various", "multiple",
    "global", "worldwide", "anywhere", "hybrid", "onsite", "on-site",
    "any location", "any", "flexible", "multiple locations", "other",
]
COUNTRY_SPLIT = r"[,/|;–—]|\s-\s"
COUNTRY_NAME_OK = r"[A-Za-z .'&-]+"

# Tuning parameters (not semantics): retirement threshold, stale margin,
# safety share.
RETIRE_AFTER = 3
STALE_MARGIN_HOURS = 2
SAFETY_FRACTION = 0.40
