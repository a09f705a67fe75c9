"""Fixed values of the data model: enumerations, limits, patterns, defaults.

These have to stay exactly as they are for results to agree with existing
datasets, so they are kept together and written out as plain text.
"""

# --- enumerations ---------------------------------------------------------
ACTION_TYPES = [
    "click", "type", "navigate", "scroll", "hover", "select",
    "submit", "back", "forward", "refresh", "wait", "drag_drop",
]
BACKTRACK_TYPES = ["back", "forward"]
USER_TYPES = ["power_user", "casual", "first_time"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
BROWSER_TYPES = ["chrome", "firefox", "safari"]
WORKFLOW_TYPES = ["e_commerce", "form_filling", "research"]
WORKFLOW_GOALS = {
    "e_commerce": ["purchase_product", "browse_products", "add_to_cart", "compare_products"],
    "form_filling": ["submit_contact_form", "create_account", "subscribe_newsletter", "request_quote"],
    "research": ["find_information", "read_article", "compare_options", "learn_topic"],
}
UNKNOWN_WORKFLOW_GOAL = "complete_task"
WORKFLOW_DOMAINS = {
    "e_commerce": ["example-store.com", "shop-example.com", "retail-test.com"],
    "form_filling": ["signup-example.com", "contact-example.com", "form-test.com"],
    "research": ["search-example.com", "wiki-example.com", "article-test.com"],
}
UNKNOWN_WORKFLOW_DOMAIN = "example.com"
WORKFLOW_MIX = {"e_commerce": 0.4, "form_filling": 0.3, "research": 0.3}

# length band -> (shortest, longest, target share)
LENGTH_BANDS = {
    "3-4": (3, 4, 0.20),
    "5-6": (5, 6, 0.40),
    "7-8": (7, 8, 0.30),
    "9-10": (9, 10, 0.10),
}

# --- limits ---------------------------------------------------------------
MIN_ACTIONS = 3
MAX_ACTIONS = 10
MAX_COORDINATE = 10000
MAX_SELECTOR_LENGTH = 500
SHORTCUT_MAX_ACTIONS = 5
REPORT_ERRORS = 10
REPORT_SAMPLES = 3
SAMPLE_SIZE = 10
DATASET_VERSION = "1.0"
SCHEMA_VERSION = "1.0"

# --- patterns -------------------------------------------------------------
URL_PATTERN = (
    r"(?i)^https?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)\z"
)
UNSAFE_SELECTOR_PARTS = ["javascript:", "data:", "vbscript:"]

# --- defaults for missing raw fields --------------------------------------
DEFAULT_URL = "https://example.com"
DEFAULT_PAGE_TITLE = "Page"

# --- timing (seconds; words per minute) -----------------------------------
NAVIGATE_SECONDS = (0.3, 3.0)
SCROLL_SECONDS = (0.5, 2.0)
TYPING_WPM = {"power_user": (60, 80), "casual": (30, 50), "first_time": (20, 40)}
DECISION_SECONDS = {"power_user": (0.5, 2.0), "casual": (1.0, 4.0), "first_time": (2.0, 8.0)}
IMPORTANT_FACTORS = (1.5, 2.0)
READING_SECONDS = {"power_user": (5, 15), "casual": (10, 30), "first_time": (15, 45)}
COMPLEXITY_FACTORS = {"low": 0.7, "medium": 1.0, "high": 1.5}
SCROLL_Y_RANGE = (100, 500)
OPTION_RANGE = (0, 4)

# Characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- wording of structural errors in raw records ---------------------------
RECORD_ERRORS = {
    "not_object": "Trajectory structure must be a dictionary",
    "no_actions": "Missing required field: 'actions'",
    "domain": "'domain' must be a string",
    "goal_achieved": "'goal_achieved' must be a boolean",
    "actions_not_list": "'actions' must be a list",
    "actions_empty": "'actions' list cannot be empty",
}
ACTION_ERRORS = {
    "not_object": "Action must be a dictionary",
    "no_action_type": "Missing required field 'action_type'",
    "action_type": "'action_type' must be a string",
    "unknown_action_type": "Invalid 'action_type' '%s'. Must be one of: %s",
    "no_url": "Missing recommended field 'url'",
    "url": "'url' must be a string",
    "url_format": "'url' has invalid format",
    "page_title": "'page_title' must be a string",
    "element_type": "'element_type' must be a string",
    "type_without_value": "'type' action should have 'value' or 'value_hint'",
    "option_index": "'select' action 'option_index' must be an integer",
    "coordinates": "'scroll' action 'coordinates' must be a dictionary",
    "coordinates_xy": "'scroll' action 'coordinates' must have 'x' and 'y'",
    "is_intentional": "'is_intentional' must be a boolean",
    "user_intent": "'user_intent' must be a string",
    "context": "'context' must be a string",
}
