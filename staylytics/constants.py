"""Lookups, thresholds and word lists that results depend on."""

# Hotel name -> key and short code (closed set: an unknown name is an error).
HOTEL_KEYS = {"Resort Hotel": 1, "City Hotel": 2}
TOTAL_ROOMS = {"Resort Hotel": 200, "City Hotel": 300}

# Room letter -> tier id; any other letter is tier 0.
ROOM_TIERS = {"A": 1, "B": 1, "C": 1, "D": 2, "E": 2, "F": 2, "G": 2, "H": 3, "L": 3}
UNMAPPED_TIER = 0
ROOM_TYPE_SEED = [(1, "Standard", 1.0), (2, "Deluxe", 1.4), (3, "Suite", 2.0)]

NON_OCCUPYING = ["Canceled", "No-Show"]
TERMINAL = ["Canceled", "Check-Out", "No-Show"]

GUEST_FIELDS = [
    "country", "market_segment", "distribution_channel", "customer_type", "is_repeated_guest", "agent", "company",
]

RAW_COLUMNS = [
    "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_week_number",
    "arrival_date_day_of_month", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies",
    "meal", "country", "market_segment", "distribution_channel", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "reserved_room_type", "assigned_room_type", "booking_changes", "deposit_type",
    "agent", "company", "days_in_waiting_list", "customer_type", "adr", "required_car_parking_spaces",
    "total_of_special_requests", "reservation_status", "reservation_status_date",
]
SENTINEL_COLUMNS = ["meal", "market_segment", "distribution_channel"]
CATEGORICAL_COLUMNS = [
    "hotel", "meal", "country", "market_segment", "distribution_channel", "reserved_room_type",
    "assigned_room_type", "deposit_type", "customer_type", "reservation_status",
]
NULLABLE_INT_COLUMNS = [
    "is_canceled", "is_repeated_guest", "required_car_parking_spaces", "total_of_special_requests",
    "booking_changes", "previous_cancellations", "previous_bookings_not_canceled", "days_in_waiting_list",
    "children", "adults", "babies", "stays_in_weekend_nights", "stays_in_week_nights", "agent", "company",
]

SEASONS = {
    12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
    6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn",
}
MONTH_DAYS = {  # in every year
    "January": 31, "February": 28, "March": 31, "April": 30, "May": 31, "June": 30,
    "July": 31, "August": 31, "September": 30, "October": 31, "November": 30, "December": 31,
}
MEALS = ["breakfast", "lunch", "dinner"]
MEAL_REVENUE_PER_ROOM = {"breakfast": 8.0, "lunch": 6.0, "dinner": 12.0}
STAFF_RATIO = {"Reception": 0.03, "Kitchen": 0.05, "Housekeeping": 0.08}
WEEKEND_FACTOR = 1.15
CHURN_WINDOW_DAYS = 180

SEVERITY_WEIGHTS = {"low": 1, "medium": 2, "high": 3, "critical": 4}

CHUNK_SIZE = 800
CHUNK_OVERLAP = 120
RETRIEVER_TOP_K = 5
CONTEXT_CHARS = 3000
MEMORY_TURNS = 8
MEMORY_TTL_SECONDS = 1800

DRIFT_SCORE_LIMIT = 0.30
QUALITY_DROP_LIMIT = 0.10

# Sentiment entries: matched as substrings of lower-cased text.
POSITIVE_WORDS = [
    "excellent", "fantastic", "great", "friendly", "clean", "spotless", "delicious", "perfect", "wonderful",
    "helpful", "reasonable", "quiet", "peaceful", "reliable", "modern", "recommend", "exceeded", "warm",
    "responsive", "professional", "easy", "secure", "beautifully", "loved",
]
NEGATIVE_WORDS = [
    "not clean", "mold", "rude", "unhelpful", "overpriced", "bland", "expensive", "overcharged", "far", "noisy",
    "inconvenient", "broken", "faulty", "leaked", "disconnecting", "slow", "unusable", "disappointing",
    "no parking", "surprise", "full", "hard", "terrible", "worse",
]
ANGRY_WORDS = ["rude", "broken", "faulty", "mold"]
EXCITED_WORDS = ["excellent", "exceeded", "loved", "fantastic"]
COMPLAINT_STOPWORDS = [
    "the", "was", "were", "we", "our", "and", "a", "to", "of", "for", "with", "in", "at", "is", "it", "on",
    "this", "that", "very", "so", "but", "had", "have", "has",
]

# Words that give away a complaint, per category: fixed values.
COMPLAINT_WORDS = {
    "cleanliness": [
        "checked", "dust", "everywhere", "looked", "mold", "not", "sheets", "used", "visible", "when",
    ],
    "food": [
        "bland", "by", "cold", "got", "often", "overpriced", "quite", "repetitive", "time",
    ],
    "staff": [
        "asked", "assistance", "complaints", "forever", "indifferent", "respond", "rude", "seemed", "took",
        "unhelpful", "whenever",
    ],
    "price": [
        "compared", "expensive", "felt", "hotels", "nearby", "overcharged", "received", "similar", "too", "way",
    ],
    "location": [
        "around", "car", "center", "city", "far", "from", "get", "hard", "inconvenient", "neighborhood", "noisy",
        "without",
    ],
    "noise": [
        "barely", "clearly", "could", "due", "extremely", "hear", "meant", "neighboring", "noise", "noisy", "rooms",
        "thin", "traffic", "walls",
    ],
    "maintenance": [
        "air", "conditioning", "door", "entire", "faulty", "fixed", "leaked", "lock", "nobody", "shower", "stay",
    ],
    "wifi": [
        "calls", "disconnecting", "kept", "painfully", "slow", "unusable", "video",
    ],
    "parking": [
        "always", "an", "away", "blocks", "fee", "full", "lot", "no", "park", "several", "surprise", "unpleasant",
    ],
    "other": [
        "again", "disappointing", "expected", "experience", "fell", "here", "not", "price", "range", "short",
        "well", "what", "would",
    ],
}

# Phrase banks per complaint category: (category, praising phrases, complaining phrases).
PHRASE_BANK = [
    ("cleanliness",
     ["The room was spotless and the housekeeping team did a fantastic job.",
      "Everything felt clean and well maintained from the lobby to the bathroom."],
     ["The room was not clean when we checked in, dust everywhere.",
      "Bathroom had visible mold and the sheets looked used."]),
    ("food",
     ["Breakfast buffet was excellent with a great variety of fresh options.",
      "The restaurant food was delicious and beautifully presented."],
     ["Breakfast was repetitive and often cold by the time we got to it.",
      "The restaurant food was overpriced and quite bland."]),
    ("staff",
     ["The staff were incredibly friendly and went out of their way to help us.",
      "Reception was warm, professional, and very responsive to our requests."],
     ["Staff were rude and unhelpful whenever we asked for assistance.",
      "Reception took forever to respond and seemed indifferent to complaints."]),
    ("price",
     ["Great value for money considering the quality of the room and service.",
      "Pricing was very reasonable for what we got, would book again."],
     ["Way too expensive for the quality of the room we received.",
      "Felt overcharged compared to similar hotels nearby."]),
    ("location",
     ["The location was perfect, walking distance to everything we wanted to see.",
      "Loved how central and convenient the hotel's location was."],
     ["The location was far from everything, hard to get around without a car.",
      "Noisy neighborhood and inconvenient distance from the city center."]),
    ("noise",
     ["Very quiet room, we slept great every night of our stay.",
      "Surprisingly peaceful for a hotel in the city center."],
     ["Extremely noisy at night, could hear traffic and neighboring rooms clearly.",
      "Thin walls meant we barely slept due to the noise."]),
    ("maintenance",
     ["Everything in the room worked perfectly, no issues at all.",
      "The facilities were modern and well kept, nothing was broken."],
     ["Air conditioning was broken for our entire stay and nobody fixed it.",
      "The shower leaked and the door lock was faulty."]),
    ("wifi",
     ["WiFi was fast and reliable throughout the entire property.",
      "Had no trouble working remotely thanks to the strong internet connection."],
     ["WiFi kept disconnecting and was unusable for video calls.",
      "Internet was painfully slow throughout the property."]),
    ("parking",
     ["Parking was easy, secure, and included in the rate.",
      "Plenty of parking space available whenever we needed it."],
     ["No parking available, we had to park several blocks away.",
      "Parking fee was an unpleasant surprise and the lot was always full."]),
    ("other",
     ["Overall a wonderful stay, we will definitely be back.",
      "Exceeded our expectations in every way, highly recommended."],
     ["Overall disappointing experience, would not stay here again.",
      "Fell well short of what we expected for this price range."]),
]

# Keyword extraction stop words (default parameter value; common English function words).
KEYWORD_STOPWORDS = [
    "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any", "are", "as", "at",
    "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "could", "did",
    "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "him", "his", "how", "if", "in", "into", "is", "it", "its", "itself",
    "just", "me", "more", "most", "my", "myself", "no", "nor", "not", "now", "of", "off", "on", "once", "only",
    "or", "other", "our", "ours", "out", "over", "own", "same", "she", "should", "so", "some", "such", "than",
    "that", "the", "their", "theirs", "them", "then", "there", "these", "they", "this", "those", "through", "to",
    "too", "under", "until", "up", "very", "was", "we", "were", "what", "when", "where", "which", "while", "who",
    "whom", "why", "will", "with", "would", "you", "your", "yours",
]

# Inputs of the models: fixed values.
OCCUPANCY_FEATURES = [
    "month", "quarter", "day_of_week", "is_weekend", "is_holiday", "is_event", "total_rooms", "occupancy_pct_lag_1",
    "occupancy_pct_lag_7", "occupancy_pct_lag_30", "occupancy_pct_rolling_mean_7", "occupancy_pct_rolling_mean_30",
]
PRICING_NUMERIC = [
    "occupancy_pct", "occupancy_7day_avg", "demand_index", "is_weekend", "is_holiday", "is_event", "base_price_multiplier",
]
PRICING_FEATURES = [*PRICING_NUMERIC, "season_code", "room_type_name_code"]
RESTAURANT_FEATURES = [
    "month", "quarter", "day_of_week", "is_weekend", "is_holiday", "is_event", "total_orders_lag_1", "total_orders_lag_7",
    "total_orders_rolling_mean_7",
]
STAFFING_FEATURES = [
    "month", "quarter", "day_of_week", "is_weekend", "is_holiday", "scheduled_employees", "present_employees_lag_7",
    "present_employees_rolling_mean_7", "department_name_code",
]
CHURN_FEATURES = ["recency_days", "frequency", "monetary", "avg_spend_per_stay", "total_nights"]

# Texts of prompts and answers: fixed values.
NO_CONTEXT = "Context: (no relevant context retrieved)"
CONTEXT_HEAD = "Context:\n"
HISTORY_HEAD = "Conversation so far:\n"
QUESTION_HEAD = "Question: "
NO_ANSWER = "I don't have an LLM provider available right now, and no relevant indexed context was found for this question."
FALLBACK_HEAD = "No LLM provider is available/configured, so here is the most relevant retrieved context for your question ('"
FALLBACK_JOIN = "'):\n\n"
