"""Prefixes, skip words, keywords and product markers of the answers.

All matching is by substring on cleaned, lower-cased lines, so some entries end in a blank on
purpose and short ones match inside words.
"""

from __future__ import annotations

# Text put before a question's arguments when it is embedded.
QUESTION_PREFIXES = {
    "warranty": "warranty support guarantee return policy ",
    "specs": (
        "technical specifications processor memory storage display battery dimensions "
        "connectivity "
    ),
    "certifications": "certifications compliance standards approvals safety ",
    "profile": "complete product profile specifications warranty certifications features ",
    "product_documents": "product specifications features warranty certifications ",
    "product_table": "product specifications features warranty ",
    "discount": "volume discount bulk order pricing policy ",
    "discount_table": "volume discount bulk order ",
}

# Lines holding one of these are document metadata.
METADATA_WORDS = [
    "document version", "effective date", "classification", "sales & marketing",
    "product line:", "brand:", "category:",
]
SPEC_METADATA_WORDS = [*METADATA_WORDS, "primary:", "secondary:", "geographic"]
DISCOUNT_METADATA_WORDS = [
    "document version", "effective date", "classification", "approved by", "last updated",
]

# Lines holding one of these belong to the answer.
WARRANTY_WORDS = [
    "warrant", "guarantee", "support", "return", "hotline", "money-back", "replacement",
    "service", "satisfaction", "on-site",
]
SPEC_WORDS = [
    "display", "processor", "memory", "storage", "battery", "weight", "dimension", "os",
    "operating", "graphics", "connectivity", "camera", "resolution", "ram", "ssd", "ghz", "inch",
    "water", "ip6", "usb", "bluetooth", "wi-fi", "5g", "nfc", "motor", "power", "torque",
    "material", "heat", "stainless", "fabric", "thread", "cut",
]
CERTIFICATION_WORDS = [
    "certif", "compli", "standard", "approv", "rated", "listed", "iso", "ce ", "fcc", "rohs",
    "epeat", "energy star", "ansi", "din", "bpa", "ul ", "safety", "oeko", "gots", "reach",
]
DISCOUNT_WORDS = [
    "discount", "volume", "bulk", "unit", "tier", "region", "minimum", "order", "rebate", "promo",
    "%", "percent",
]

# Sections of a product profile; a line goes to the first section it matches.
PROFILE_WARRANTY_WORDS = [
    "warrant", "guarantee", "support", "hotline", "money-back", "return", "satisfaction",
    "on-site", "replacement",
]
PROFILE_CERTIFICATION_WORDS = [
    "certif", "compli", "iso", "ce ", "fcc", "rohs", "epeat", "energy star", "ansi", "din", "bpa",
    "ul ", "rated", "listed", "safety",
]
PROFILE_SPEC_WORDS = [
    "display", "processor", "memory", "storage", "battery", "weight", "dimension", "os", "camera",
    "connectivity", "ram", "ssd", "ghz", "inch", "ip6", "usb", "bluetooth", "wi-fi", "5g",
    "motor", "power", "torque", "material", "heat", "stainless", "fabric",
]

# Words that mark a line as being about another product, by product asked for.
OTHER_PRODUCT_MARKERS = {
    "laptop 14": [
        "drillmaster", "kitchen", "classic jeans", "classic tee", "hand tool", "smartphone",
    ],
    "5g smartphone": [
        "drillmaster", "kitchen", "classic jeans", "classic tee", "hand tool", "laptop",
    ],
    "power drill": [
        "laptop", "smartphone", "kitchen", "classic jeans", "classic tee", "hand tool",
    ],
    "kitchen set": [
        "laptop", "smartphone", "drillmaster", "classic jeans", "classic tee", "hand tool",
    ],
    "classic jeans": [
        "laptop", "smartphone", "drillmaster", "kitchen", "classic tee", "hand tool",
    ],
    "classic tee": [
        "laptop", "smartphone", "drillmaster", "kitchen", "classic jeans", "hand tool",
    ],
    "hand tool set": ["laptop", "smartphone", "kitchen", "classic jeans", "classic tee"],
}
# For warranty questions two products exclude the drill's hotline as well.
WARRANTY_OTHER_PRODUCT_MARKERS = {
    **OTHER_PRODUCT_MARKERS,
    "laptop 14": [*OTHER_PRODUCT_MARKERS["laptop 14"], "1-800-dril"],
    "5g smartphone": [*OTHER_PRODUCT_MARKERS["5g smartphone"], "1-800-dril"],
}
