"""Domain constants of the windowed job and its event generator."""

from __future__ import annotations

# --- FIXED VALUES: must equal the original job/generator for equal results ---
CATEGORIES = ("electronics", "clothing", "books", "sports", "home", "beauty", "toys")

PRODUCTS = {
    "electronics": ("laptop", "smartphone", "headphones", "tablet", "smartwatch"),
    "clothing": ("jacket", "jeans", "sneakers", "dress", "hoodie"),
    "books": ("novel", "textbook", "cookbook", "biography", "comic"),
    "sports": ("yoga_mat", "dumbbells", "bike_helmet", "running_shoes", "water_bottle"),
    "home": ("lamp", "pillow", "coffee_maker", "candle", "plant_pot"),
    "beauty": ("moisturizer", "lipstick", "perfume", "shampoo", "serum"),
    "toys": ("lego_set", "board_game", "action_figure", "puzzle", "rc_car"),
}

PRICE_RANGES = {
    "electronics": (50, 1500),
    "clothing": (15, 250),
    "books": (5, 80),
    "sports": (10, 400),
    "home": (8, 300),
    "beauty": (5, 150),
    "toys": (10, 200),
}

EVENT_TYPES = ("view", "cart", "purchase")
EVENT_WEIGHTS_PCT = (60, 25, 15)

USER_COUNT = 500
SESSION_COUNT = 100
PRODUCT_NUMBERS = 50

EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
WATERMARK_DELAY = "10 seconds"
DEFAULT_WINDOW_MINUTES = 1

REPORT_PERIOD = "1 hour"
REPORT_LIMIT = 100
ADHOC_LIMIT = 10

# Frame of the printed report.
REPORT_TITLE = "  CLICKSTREAM ANALYTICS REPORT — Last 60 Minutes"
NO_DATA = "  No data yet. The streaming job may still be warming up."
DOUBLE_RULE = "=" * 75
SINGLE_RULE = "-" * 75
# -----------------------------------------------------------------------------

PURCHASE = "purchase"
# ISO-8601 with six fraction digits and a "+00:00" style offset (lower-case
# xxx prints +00:00 for UTC where XXX would print Z).
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
