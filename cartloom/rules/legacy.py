"""Older seven-type rule set, for exports made before protective gear and coaching were folded in.

Fixed values: mappings and orders are given data; results depend on their spelling and order.
"""

CATEGORY_TYPES = {
    "shorts": "shorts-pants",
    "pants": "shorts-pants",
    "bikini bottoms": "shorts-pants",
    "t-shirts": "tops",
    "singlets": "tops",
    "top crop": "tops",
    "polo shirts": "tops",
    "hoodies": "hoodies-jackets",
    "jackets": "hoodies-jackets",
    "sweater": "hoodies-jackets",
    "rain jacket": "hoodies-jackets",
    "sweat suit": "hoodies-jackets",
    "jerseys": "jerseys",
    "kneepads": "protective-gear",
    "sleeves": "protective-gear",
    "elbow pads": "protective-gear",
    "socks": "accessories",
    "backpacks & bags": "accessories",
    "coaching": "coaching",
}
TYPE_PRIORITY = [
    "jerseys", "protective-gear", "coaching", "hoodies-jackets", "shorts-pants", "tops", "accessories",
]
NAME_TYPES = [
    ("jersey", "jerseys"),
    ("knee", "protective-gear"),
    ("elbow", "protective-gear"),
    ("sleeve", "protective-gear"),
    ("hoodie", "hoodies-jackets"),
    ("jacket", "hoodies-jackets"),
    ("sweat", "hoodies-jackets"),
    ("tracksuit", "hoodies-jackets"),
    ("pant", "shorts-pants"),
    ("short", "shorts-pants"),
    ("bikini", "shorts-pants"),
    ("singlet", "tops"),
    ("tee", "tops"),
    ("t-shirt", "tops"),
    ("t shirt", "tops"),
    ("shirt", "tops"),
    ("crop", "tops"),
    ("polo", "tops"),
    ("top", "tops"),
    ("sock", "accessories"),
    ("bag", "accessories"),
    ("backpack", "accessories"),
    ("cap", "accessories"),
    ("towel", "accessories"),
    ("tape", "accessories"),
    ("board", "coaching"),
]
