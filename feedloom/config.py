"""Fixed values and settings.

Brand names, product catalogues and "our own brands" describe a deployment, not
the library, so they have no defaults here: callers pass them to the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: enumerations, in their defined order -----------------------

THEMES = [
    "durability", "noise", "usability", "cleaning", "power", "size",
    "price_value", "aesthetics", "packaging", "customer_service", "battery",
    "smell", "accessories", "setup", "safety",
]

THEME_LABELS = {
    "durability": "Durability",
    "noise": "Noise",
    "usability": "Usability",
    "cleaning": "Cleaning",
    "power": "Power/Suction",
    "size": "Size/Weight",
    "price_value": "Price/Value",
    "aesthetics": "Aesthetics",
    "packaging": "Packaging",
    "customer_service": "Customer Service",
    "battery": "Battery Life",
    "smell": "Smell/Odor",
    "accessories": "Accessories",
    "setup": "Setup",
    "safety": "Safety",
}

SENTIMENTS = ["positive", "negative", "mixed", "neutral"]

ISSUE_SENTIMENTS = ["negative", "mixed"]

SOURCES = ["amazon", "reddit", "bestbuy", "trustpilot"]

# --- Fixed values: landing maps -----------------------------------------------

# Java patterns for "March 5, 2024", "2024-03-05", "03/05/2024", "5 March 2024".
DATE_FORMATS = ["MMMM d, yyyy", "yyyy-M-d", "M/d/yyyy", "d MMMM yyyy"]

POSITIVE_WORDS = ["love", "great", "best", "amazing", "excellent", "recommend"]

NEGATIVE_WORDS = ["hate", "worst", "terrible", "broke", "returned", "avoid", "waste"]

# --- Fixed values: cleaning ---------------------------------------------------

SPAM_PATTERNS = [
    r"buy\s+now\s+at",
    r"visit\s+(my|our)\s+(website|site|link)",
    r"(discount|coupon)\s+code",
    r"click\s+here",
    r"free\s+trial",
    r"100%\s+guaranteed",
]

SHIPPING_PATTERNS = [
    r"^(arrived|delivered|shipping|package|box)\b",
    r"\b(ups|fedex|usps|delivery driver)\b",
]

PRODUCT_PATTERNS = [
    r"\b(suction|power|noise|battery|clean|brush|blend|cook|brew|fry|heat)\b",
]

# --- Fixed values: classification ---------------------------------------------

HEDGES = ["however", "but", "although", "on the other hand"]

THEME_KEYWORDS = {
    "power": "power",
    "suction": "power",
    "usability": "usability",
    "easy": "usability",
    "noise": "noise",
    "loud": "noise",
    "quiet": "noise",
    "battery": "battery",
    "broke": "durability",
    "broken": "durability",
    "stopped working": "durability",
    "cracked": "durability",
    "peeling": "durability",
    "clean": "cleaning",
    "price": "price_value",
    "worth": "price_value",
    "expensive": "price_value",
    "size": "size",
    "small": "size",
    "large": "size",
    "heavy": "size",
    "smell": "smell",
    "plastic smell": "smell",
    "setup": "setup",
    "customer service": "customer_service",
}

FAILURE_MODES = {
    "durability": [
        "Motor failure", "Plastic component cracked", "Coating peeled",
        "Stopped powering on", "Battery won't hold charge", "Brush roll broke",
    ],
    "noise": ["Excessive motor noise", "Grinding sound developed"],
    "cleaning": ["Filter clogging", "Difficult to disassemble"],
}

HAZARD_WORDS = ["safety", "dangerous"]

FEATURE_WORDS = [
    "dust cup", "brush roll", "filter", "motor", "battery", "handle",
    "basket", "blade", "grinder", "water tank", "screen", "nozzle",
    "hose", "cord", "charger", "app", "sensor", "suction",
]

FAILURE_DETAIL = "Address reported failure mode"

# --- Fixed values: analysis ---------------------------------------------------

RISK_SIGNALS = [
    "return", "returned", "returning", "refund", "money back",
    "waste of money", "don't buy", "do not buy", "avoid",
    "worst purchase", "throwing it away", "threw it out",
    "never again", "stay away", "garbage", "junk",
]

BAND_COLOURS = {"Green": "#3FB950", "Yellow": "#D29922", "Red": "#F85149"}

# --- Fixed values: model prices per million tokens (input, output) ------------

PRICES = {"base": (0.80, 4.00), "strong": (3.00, 15.00)}

UNKNOWN_PRICE = (3.00, 15.00)


@dataclass(frozen=True)
class RuleSet:
    """Word lists behind the offline rule classifier."""

    theme_keywords: dict = field(default_factory=lambda: dict(THEME_KEYWORDS))
    failure_modes: dict = field(default_factory=lambda: dict(FAILURE_MODES))
    hazard_words: tuple = tuple(HAZARD_WORDS)
    mention_brands: tuple = ()  # the brands of a deployment
    feature_words: tuple = tuple(FEATURE_WORDS)
    default_theme: str = "usability"
    seed: str = "42"


@dataclass(frozen=True)
class Settings:
    """Everything a batch run needs to know about its deployment."""

    own_brands: tuple
    as_of: str
    top_n: int = 10
    decay_days: int = 180
    recent_days: int = 90
    growth_ratio: float = 1.5
    min_recent: int = 5
    min_sample: int = 3
    phrase_n: int = 20
    min_text: int = 20
    near_dup_percent: int = 95
    near_dup_chars: int = 200
    near_dup_whole: bool = True  # whole texts confirm what their openings suggest
    language: str = "en"
    language_chars: int | None = None  # the whole text
    risk_signals: tuple = tuple(RISK_SIGNALS)
    briefs: tuple = ()  # pairs of a category and a brand that get a brief
    rules: RuleSet = field(default_factory=RuleSet)
