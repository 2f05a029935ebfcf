"""Vocabularies of the registered queries, fit for the test tables; operators take them as arguments."""

HOSTING = ["invalid"]
BLOCKED = ["ads", "spam", "vava"]
EXCLUDED_HOSTS = ["inkwharf.example", "panelbay.example"]
EXCLUDE_URL = r"(?:/list|/hot|/new)(?:[/?#]|$)"
WANTED_URL = [r"/(?:comic|series|title|book|manga|manhua)/", r"/(?:chapter|episode|read)/"]
PATH_TOKENS = ["/book/", "utm_source"]
SKIP_LINKS = ["utm_", "/login", ".css"]
PLACEHOLDER = r"^(?:null|undefined|NaN)\z"
CHAPTER = r"(?i)chapter|episode|第[0-9]+"
CHAPTER_URL = r"/(?:chapter|episode|read)/"
BARE = ["manga", "comic", "legend"]
GENERIC = ["manga", "comics"]
NOISE_PREFIX = r"^(?:read|free) "
TITLE_NOISE = r"(?s)\s*(?:[_|/]|\s-\s).*\z"
TAG_WORDS = ["传说", "Legend", "日记"]
CATEGORIES = [("water", ["harbor", "ferry", "well", "渡船", "古井"]), ("music", ["bell", "violin", "铜钟", "琴弦"]), ("travel", ["map", "compass", "地图", "罗盘"]), ("home", ["teapot", "umbrella", "茶壶", "雨伞"])]
TAGS = [("garden", ["garden", "orchard", "花园", "果园"], "home"), ("light", ["lantern", "灯笼"], None), ("stairs", ["staircase", "楼梯"], "travel")]
PATTERNS = [("ink", "https://{domain}/find?q={keyword}"), ("manga", "https://{domain}/manga/{keyword}"), ("comic", "https://{domain}/comics?s={keyword}"), ("toon", "https://{domain}/t/{keyword}")]
DEFAULT_TEMPLATE = "https://{domain}/search?keyword={keyword}"
SEED_PATHS = [("manga", ["/manga", "/latest"]), ("comic", ["/comics"]), ("toon", ["/toons", "/new"])]
ANTI, TITLE_WORDS, VALIDATE, SECONDARY = ["error", "parked"], ["shop", "casino"], ["chapter", "episode", "comic", "manga"], ["reader", "page", "volume", "story"]
MODIFIERS = ["online", "free", "latest"]
ENGINES = ["seekra", "minnow", "wanderlens", "tidepool_html", "seed_page"]
