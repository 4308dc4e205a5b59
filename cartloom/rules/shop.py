"""Example rule set of a sports-apparel shop. Operators take any other set as an argument.

Fixed values: the word lists, mappings and orders in this module are given data; results depend on
their exact spelling and order.
"""

from __future__ import annotations

#: attribute name -> (policy, canonical name)
ATTRIBUTE_POLICY = {
    "color": ("option", "Colour"),
    "colour": ("option", "Colour"),
    "size": ("option", "Size"),
    "gender": ("option", "Gender"),
    "hats": ("label", "Hats"),
    "condition": ("decision", "Condition"),
    "number": ("decision", "Number"),
}
MAX_OPTIONS = 3

COLOUR_SYNONYMS = {
    "navy blue": "Navy",
    "navy": "Navy",
    "gray": "Grey",
    "light gray": "Grey",
    "grey": "Grey",
    "light grey": "Grey",
    "royal blue": "Royal Blue",
    "sky blue": "Sky Blue",
    "black": "Black",
    "white": "White",
    "blue": "Blue",
    "red": "Red",
    "green": "Green",
    "orange": "Orange",
    "yellow": "Yellow",
    "pink": "Pink",
    "royal": "Royal",
}
SIZE_SYNONYMS = {
    "XXS": "2XS",
    "XXL": "2XL",
    "XXXL": "3XL",
    "3X": "3XL",
    "2X": "2XL",
    "SM": "S/M",
    "ML": "M/L",
}
GENDER_SYNONYMS = {
    "male": "Men",
    "man": "Men",
    "men": "Men",
    "mens": "Men",
    "female": "Women",
    "woman": "Women",
    "women": "Women",
    "womens": "Women",
    "unisex": "Unisex",
}
SIZE_ORDER = [
    "4XS", "3XS", "2XS", "XS", "S", "S/M", "M", "M/L", "L", "XL",
    "2XL", "3XL", "4XL", "5XL", "6XL", "7XL", "8XL",
]

TYPE_TITLES = {
    "tops": "Tops",
    "shorts-pants": "Shorts & Pants",
    "hoodies-jackets": "Hoodies & Jackets",
    "jerseys": "Jerseys",
    "accessories": "Accessories",
}
TYPE_PRIORITY = ["jerseys", "hoodies-jackets", "shorts-pants", "tops", "accessories"]
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
    "kneepads": "accessories",
    "sleeves": "accessories",
    "elbow pads": "accessories",
    "socks": "accessories",
    "backpacks & bags": "accessories",
    "ball cart / trolley": "accessories",
    "coaching": "accessories",
}
#: (keyword in the product name, type), first hit wins
NAME_TYPES = [
    ("jersey", "jerseys"),
    ("knee", "accessories"),
    ("elbow", "accessories"),
    ("sleeve", "accessories"),
    ("hoodie", "hoodies-jackets"),
    ("jacket", "hoodies-jackets"),
    ("sweat", "hoodies-jackets"),
    ("tracksuit", "hoodies-jackets"),
    ("jogger", "hoodies-jackets"),
    ("pant", "shorts-pants"),
    ("short", "shorts-pants"),
    ("bikini", "shorts-pants"),
    ("singlet", "tops"),
    ("tee", "tops"),
    ("t-shirt", "tops"),
    ("t shirt", "tops"),
    ("polo", "tops"),
    ("crop", "tops"),
    ("shirt", "tops"),
    ("top", "tops"),
    ("sock", "accessories"),
    ("bag", "accessories"),
    ("backpack", "accessories"),
    ("cart", "accessories"),
    ("hat", "accessories"),
    ("cap", "accessories"),
    ("towel", "accessories"),
    ("tape", "accessories"),
    ("board", "accessories"),
]
FALLBACK_TYPE = "accessories"

SURFACE_TITLES = {"beach": "Beach", "indoor": "Indoor"}
BEACH_CATEGORIES = ["beach volleyball", "bikini bottoms"]
INDOOR_CATEGORIES = ["jerseys", "kneepads", "elbow pads"]
WOMEN_CATEGORIES = ["women", "top crop", "bikini bottoms"]

#: (handle, title, category, words in the name); placeholder clubs, a shop passes its own
CLUBS = [
    ("north-academy", "North Academy", "north academy", "north academy"),
    ("west-club", "West Club", "west club", "west club"),
]
TEAMWEAR = ("teamwear", "Teamwear", "teamwear")

SURFACE_CHOICES = ["beach", "indoor"]
GENDER_CHOICES = ["Men", "Unisex", "Women"]
CLUB_CHOICES = sorted([*(c[0] for c in CLUBS), TEAMWEAR[0]])

FUNCTIONAL_PAGE = r"^(cart|checkout|my-account|wishlist|shop|order-tracking)(-\d+)?$"
ADVANCED_COUPON_PREFIXES = ["_acfw", "_wjecf", "_flexible_coupon"]
COLOUR_ATTRIBUTES = ["colour", "color", "pa_colour", "pa_color"]
BARCODE_FIELD = "usbs_barcode_field"
