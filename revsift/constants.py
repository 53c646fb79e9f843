"""Label domain, lexicons and patterns.

FIXED VALUES: everything in this module must equal the values the
moderation rules were defined with (word lists, category keys, domain
terms, regular expressions, label codes).  They are stated here once, in
their natural order, and every Spark expression and oracle SQL string is
built from them.  Do not edit them to make a result change.
"""

from __future__ import annotations

# ---------------------------------------------------------------- labels
ABSTAIN = -1
GENUINE = 0
PROMOTION = 1
IRRELEVANT = 2
RANT = 3

LABEL_NAMES = {
    ABSTAIN: "ABSTAIN",
    GENUINE: "GENUINE",
    PROMOTION: "PROMOTION",
    IRRELEVANT: "IRRELEVANT",
    RANT: "RANT",
}
CLASSES = (GENUINE, PROMOTION, IRRELEVANT, RANT)
CARDINALITY = len(CLASSES)

# ---------------------------------------------------------------- lexicons (fixed values)
PROMO_WORDS = [
    "discount", "free", "promo", "coupon", "code", "deal", "offer", "save $", "% off",
    "buy", "purchase", "sale", "promotion", "promotional", "special offer", "limited time",
    "best price", "cheap", "cheapest", "cheap deal", "visit our website", "follow us",
    "subscribe", "contact us", "call now", "sign up", "join now", "check out", "shop now",
    "recommended by", "must-have",
]

NEVER_VISITED_PHRASES = [
    "never visited", "never been", "haven't been", "haven't visited", "didn't go",
    "not been", "not go", "hasn't been", "hasn't visited", "never actually went",
    "not visited", "someone told me", "i read that", "was not there", "i heard",
    "seems", "probably", "think", "might", "looks",
]

# Ordered: the first family with a key that is a substring of the category wins.
FAMILY_MAP = {
    "restaurant": [
        "restaurant", "fast food", "bar & grill", "grill", "steakhouse", "bbq", "pizzeria",
        "pizza", "sandwich shop", "burger", "mexican restaurant", "american restaurant",
        "breakfast restaurant", "takeout restaurant", "ice cream", "diner", "seafood",
        "sushi", "ramen", "noodle", "buffet", "curry", "taco", "wing", "bistro",
    ],
    "cafe_coffee_bakery": [
        "coffee", "coffee shop", "cafe", "tea", "bubble tea", "bakery", "donut", "pastry",
        "dessert", "bagel",
    ],
    "bar_pub": ["bar", "pub", "taproom", "brewery", "distillery", "wine bar"],
    "hotel_lodging": ["hotel", "motel", "lodging", "resort", "inn", "hostel"],
    "campground_rv": ["campground", "rv", "rv park", "trailer park"],
    "attraction_park": [
        "tourist attraction", "park", "trail", "hiking", "monument", "museum", "zoo",
        "aquarium", "art gallery", "theater", "amusement", "river", "lake", "hot spring",
        "national park", "state park", "scenic", "viewpoint",
    ],
    "grocery_convenience": [
        "grocery store", "supermarket", "convenience store", "market", "liquor store",
        "butcher", "fishmonger", "deli",
    ],
    "retail_general": ["store", "shopping", "gift shop", "thrift", "consignment", "flea market"],
    "retail_clothing": ["clothing store", "apparel", "boutique", "shoe", "jewelry"],
    "retail_specialty": [
        "electronics", "hardware", "furniture", "book", "pet store", "sporting goods",
        "outdoor store", "auto parts store", "tire shop", "pharmacy",
    ],
    "auto_service": [
        "auto repair", "car repair", "auto service", "oil change", "tire shop", "body shop",
        "car wash", "car detailing",
    ],
    "fuel_station": ["gas station", "fuel", "truck stop"],
    "transport": ["airport", "bus station", "train station", "taxi", "rideshare"],
    "healthcare": [
        "clinic", "hospital", "urgent care", "pharmacy", "dentist", "chiropractor",
        "optometrist", "veterinary", "rehabilitation", "wellness", "holistic", "alternative medicine",
    ],
    "beauty_wellness": [
        "beauty salon", "hair salon", "barber", "spa", "nail", "massage", "tattoo", "piercing",
    ],
    "real_estate": ["real estate", "property management", "apartment", "housing"],
    "professional_services": [
        "lawyer", "attorney", "accountant", "insurance", "consultant", "marketing",
        "photography", "printing", "copy center", "it service", "computer repair",
    ],
    "finance": ["bank", "credit union", "atm", "loan", "financial"],
    "education": [
        "school", "high school", "college", "university", "library", "child care", "daycare",
    ],
    "religious": ["church", "temple", "mosque", "synagogue"],
    "government_postal": [
        "city hall", "county", "government", "dmv", "post office", "courthouse", "fire station",
        "police", "sheriff",
    ],
}
GENERIC_FAMILY = "generic"

DOMAIN_TERMS = {
    "restaurant": [
        "food", "menu", "dish", "meal", "taste", "flavor", "service", "staff", "server", "waiter", "waitress",
        "drink", "coffee", "tea", "soda", "beer", "wine", "cocktail", "portion", "price", "bill", "order",
        "table", "seat", "reservation", "ambience", "ambiance", "atmosphere", "spicy", "crispy", "fresh",
        "sauce", "salad", "appetizer", "entree", "dessert", "breakfast", "lunch", "dinner", "queue", "takeout", "delivery",
    ],
    "cafe_coffee_bakery": [
        "coffee", "latte", "espresso", "americano", "cappuccino", "mocha", "bean", "brew", "roast", "barista",
        "tea", "milk tea", "boba", "bubble", "pastry", "cake", "cookie", "muffin", "bagel", "bread", "croissant",
        "dessert", "sweet", "sugar", "bakery", "counter", "cup", "mug", "foam", "crema",
    ],
    "bar_pub": [
        "beer", "tap", "pint", "ale", "lager", "ipa", "stout", "wine", "whiskey", "bourbon", "vodka", "rum",
        "cocktail", "bar", "happy hour", "bartender", "pub", "shots", "craft", "brews",
    ],
    "hotel_lodging": [
        "room", "bed", "king", "queen", "suite", "stay", "check-in", "checkin", "checkout", "front desk",
        "lobby", "housekeeping", "clean", "towel", "amenities", "breakfast", "wifi", "parking", "quiet",
        "noise", "view", "elevator", "ac", "heater", "pool", "gym", "spa", "resort",
    ],
    "campground_rv": [
        "camp", "camping", "tent", "rv", "hookup", "site", "fire pit", "picnic", "trail", "hike", "bathhouse",
        "restroom", "nature", "wildlife", "shade", "spot", "reservation", "check-in",
    ],
    "attraction_park": [
        "trail", "hike", "scenic", "view", "overlook", "waterfall", "river", "lake", "wildlife", "museum",
        "exhibit", "gallery", "show", "performance", "theater", "park", "picnic", "playground", "entrance", "fee",
    ],
    "grocery_convenience": [
        "grocery", "produce", "vegetable", "fruit", "meat", "dairy", "milk", "bread", "egg", "aisle", "shelf",
        "checkout", "cashier", "receipt", "cart", "basket", "price", "deal", "sale", "stock", "inventory",
    ],
    "retail_general": [
        "store", "cashier", "checkout", "receipt", "return", "refund", "stock", "aisle", "price", "sale", "deal",
    ],
    "retail_clothing": [
        "clothing", "apparel", "shirt", "pants", "jeans", "dress", "shoe", "size", "fit", "try on", "fitting",
        "style", "fashion", "fabric", "return", "exchange",
    ],
    "retail_specialty": [
        "electronics", "hardware", "tools", "laptop", "phone", "printer", "paint", "nail", "screw", "pet food",
        "leash", "pharmacy", "medication", "prescription", "tire", "oil", "filter", "book", "novel",
    ],
    "auto_service": [
        "car", "auto", "vehicle", "repair", "service", "maintenance", "oil change", "brake", "tire", "alignment",
        "inspection", "diagnostic", "mechanic", "appointment", "quote", "warranty", "shop", "garage",
    ],
    "fuel_station": [
        "gas", "fuel", "pump", "diesel", "octane", "station", "price", "pay", "cashier", "restroom", "convenience",
    ],
    "transport": [
        "airport", "flight", "terminal", "gate", "boarding", "bus", "route", "schedule", "ticket", "train",
        "platform", "taxi", "pickup", "dropoff",
    ],
    "healthcare": [
        "clinic", "doctor", "physician", "nurse", "appointment", "checkup", "diagnosis", "treatment", "prescription",
        "pharmacy", "medicine", "therapy", "rehab", "chiropractor", "x-ray", "insurance", "copay", "waiting room",
    ],
    "beauty_wellness": [
        "salon", "stylist", "haircut", "color", "perm", "nails", "manicure", "pedicure", "massage", "facial",
        "spa", "wax", "barber", "shave", "appointment", "booking",
    ],
    "real_estate": [
        "real estate", "agent", "realtor", "listing", "showing", "closing", "mortgage", "lease", "rent", "tenant",
        "property", "inspection", "offer", "escrow", "hoa",
    ],
    "professional_services": [
        "lawyer", "attorney", "case", "court", "contract", "accountant", "tax", "audit", "consult", "it support",
        "network", "backup", "marketing", "campaign", "project", "quote", "invoice",
    ],
    "finance": [
        "bank", "branch", "teller", "atm", "loan", "credit", "debit", "account", "deposit", "withdraw",
        "interest", "fee", "transfer", "mortgage",
    ],
    "education": [
        "school", "teacher", "class", "student", "lesson", "course", "library", "study", "homework", "campus",
    ],
    "religious": [
        "church", "mass", "service", "pastor", "sermon", "worship", "congregation", "temple", "mosque", "synagogue",
    ],
    "government_postal": [
        "city hall", "county", "government", "permit", "license", "clerk", "post office", "mail", "package",
        "shipping", "passport", "court", "dmv", "sheriff", "police", "fire station",
    ],
    "generic": [],
}

WHITELIST_COMMON = [
    "good", "great", "nice", "amazing", "awesome", "love", "like", "service", "place",
    "staff", "people", "time", "today", "yesterday", "experience", "best", "better",
    "bad", "okay", "ok", "friendly", "helpful", "clean", "dirty", "fast", "slow",
]

# ---------------------------------------------------------------- patterns (fixed values)
# All are case-insensitive except where noted; the same text runs on
# Java regex (Spark) and RE2 (the DuckDB oracle).
NEVER_EXPLICIT_RX = (
    r"(never\s+(been|visited)|haven'?t\s+(been|visited)|didn'?t\s+(go|visit)|"
    r"\bnot\s+(been|go|visit)\b|was(n't| not)\s+there|"
    r"\bnever\s+actually\s+(went|visited)\b)"
)
HEARSAY_RX = (
    r"\b(i\s+heard|someone\s+said|people\s+say|they\s+say|"
    r"i\s+read\s+(online|about)|rumor(ed)?)\b"
)
DRIVEBY_RX = r"\b(drove\s+by|drove\s+past|passed\s+by|just\s+saw\s+it)\b"
PHONE_ONLY_RX = (
    r"\b(called|phoned|on\s+the\s+phone|left\s+a\s+message|voicemail|"
    r"no\s+answer|line\s+was\s+busy)\b"
)
CLOSED_NO_ENTRY_RX = (
    r"\b(closed\s+when\s+we\s+arrived|could(n't| not)\s+get\s+in|"
    r"no\s+reservation|turn(ed)?\s+away)\b"
)
POLITICS_RX = r"\b(election|president|congress|parliament|democrat|republican|left|right|policy|politics)\b"
EMPLOYMENT_RX = r"\b(hiring|apply|resume|vacancy|job\s+opening|career|recruit|salary|benefit)\b"
GENERIC_TEMPLATE_RX = r"^(nice|great|good|amazing)\s+(place|food|service)$"

URL_RX = r"(http[s]?://|www\.)\S+"
EMAIL_RX = r"\b[\w\.-]+@[\w\.-]+\.\w{2,4}\b"
PHONE_RX = r"(\+?\d{1,3}[-.\s]?)?(\(?\d{2,4}\)?[-.\s]?)?\d{3,4}[-.\s]?\d{4}"
SOCIAL_RX = r"@\w+|\binstagram|facebook|tiktok|follow\s+us\b"  # on lowercased text, no flag
COMPARE_RX = r"\b(vs|compared to|better than|worse than)\b"       # on lowercased text
PROPER_NAME_RX = r"\b[A-Z][a-z]{2,}\b"                              # case-sensitive, original text
WORD_RX = r"\b\w+\b"
LETTER_TOKEN_RX = r"\b[a-z]+\b"

GENERIC_SHORT_PHRASES = ["good place", "nice food", "great service", "amazing place"]
HEARSAY_NEGATIVE = ["terrible", "scam", "awful", "worst", "cheated", "fraud", "rude", "waste", "avoid"]
HQ_FIRST_PERSON = [" i ", " me ", " my ", " we ", " our "]
HQ_PAST_TENSE = [" was ", " were ", " did ", " had ", " ordered ", " visited ", " went ", " came ", " ate ", " paid "]
FP_PRONOUNS = [" i ", " we ", " my ", " our "]
FP_VERBS = [" was ", " went ", " had ", " ordered ", " ate ", " visited "]
DESCRIPTIVE_TERMS = [
    " delicious ", " crispy ", " spicy ", " sweet ", " salty ", " creamy ", " crunchy ", " tender ",
    " juicy ", " friendly staff ", " clean room ", " comfortable bed ",
]

# ---------------------------------------------------------------- thresholds (fixed values)
OFFDOMAIN_MIN_TOKENS = 25
OFFDOMAIN_MAX_DOMAIN_HITS = 2       # abstain when hits >= this
OFFDOMAIN_MAX_DOMAIN_RATIO = 0.12   # abstain when ratio >= this
OFFDOMAIN_MIN_OFF_RATIO = 0.90      # vote when off ratio > this
DOMAIN_HITS_MIN_TOKENS = 6
DOMAIN_HITS_MIN = 3
LENGTH_QUANTILES = (0.01, 0.99)
RATING_RANGE = (1.0, 5.0)
NONE_TOKEN = "NONE"

# Python's str.isspace() set, written out so Java regex and RE2 agree.
WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Spark's English stop-word list (StopWordsRemover.loadDefaultStopWords("english")),
# written out so the SQL oracle sees the same list; a test checks equality.
SPARK_ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've",
    "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
]
