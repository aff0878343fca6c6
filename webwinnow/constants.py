"""Word lists, selectors, patterns, thresholds and formats.

Everything in this file must keep its exact value (and, where it is a list,
its order) for results to match.
"""

# Container probes, in order, and the tokens of the id/class pattern search.
SEMANTIC_SELECTORS = ("main", "article", '[role="main"]', '[role="article"]')
PATTERN_TOKENS = ("content", "main", "article", "body", "post", "entry", "story")
DENSITY_TAGS = ("main", "article", "section", "div")
MIN_CONTAINER_TEXT = 50
SEMANTIC_CONFIDENCE, PATTERN_CONFIDENCE, DENSITY_CONFIDENCE, BODY_CONFIDENCE = 1.0, 0.6, 0.4, 0.2

# Challenge pages.
ANTI_BOT_TITLE = (
    "robot", "captcha", "challenge", "verify", "are you human", "access denied", "blocked",
    "please verify", "unusual activity", "security check", "bot detection",
)
ANTI_BOT_BODY = (
    "unusual activity from your computer",
    "please click the box below to let us know you're not a robot",
    "verify you are human",
    "access denied",
    "please verify your identity",
)

# Block scoring.
LEAF_TAGS = (
    "p", "pre", "td", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "figcaption", "dt", "dd",
)
DIV_BREAKERS = ("div", "p", "ul", "ol", "table")
CONTENT_TAGS = (
    "p", "article", "section", "li", "td", "blockquote", "pre",
    "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "figcaption",
)
MIN_BLOCK_TEXT = 25
SCORE_THRESHOLD = 0.5
LINK_NOISE = 0.5
COMMA_WEIGHT = 0.1
PROTECT_TEXT = 15
MAX_NOISE_BLOCKS = 10

# Noise selectors, in matching order.
STATIC_NOISE = (
    "nav", "aside", "footer", "header",
    ".ad-banner", ".ad-slot", ".ad-container", ".ad-wrapper", "#ad-banner", "#ad-slot", "#ad-container",
    ".modal", ".popup", ".cookie-banner", ".consent-banner",
    ".newsletter", "#newsletter", ".newsletter-signup", ".survey", "#survey",
    ".social-share", ".share-buttons", ".social-icons",
    ".sidebar-widget", ".related-posts", ".recommended",
    "script", "style", "noscript", "link[rel='import']",
)
NOISE_TEXT_CAP = 60

# Validation passes: minimum text, commas and average score, maximum link density.
PASS1 = (200, 2, 3.0, 0.4)
PASS2 = (100, 1, 1.0, 0.6)
PASS3_MIN_TEXT = 32
WARN_RELAXED = "Relaxed validation -- content may include some noise"
WARN_FALLBACK = "Fallback validation -- low confidence (%d chars, %d commas)"
WARN_TOO_SHORT = "Content too short (%d chars) -- consider body fallback"
WARN_NO_CONTENT = "No content found in selector"
WARN_NO_MATCH = "Content check returned empty"

# Content floors and the fallback ladder.
EMPTY_FLOOR = 1
SHORT_FLOOR = 32
STARVED_FLOOR = 8
SOFT_CONFIDENCE_CAP = 0.15
HEAL_LADDER = ("main", "article", '[role="main"]', '[role="article"]', "body")
MARKDOWN_MIN_HTML = 100

# Embedded frames.
TRACKING_SUBSTRINGS = (
    "doubleclick.net", "google-analytics.com", "googletagmanager.com", "facebook.net", "facebook.com/tr",
    "linkedin.com/collect", "reddit.com/rp.gif", "sharethis.com", "twitter.com/i", "google.com/recaptcha",
    "google.com/ccm", "ads.", "analytics.", "tracking.", "pixel.", "fls.doubleclick", "adservice.google",
)
MIN_IFRAME_WIDTH, MIN_IFRAME_HEIGHT = 300, 200
MIN_EMBED_TEXT = 100
EMBED_SECTION = "\n\n---\n\n### Embedded: %s\n\n%s"

# Text quality.
BOILERPLATE = (
    r"cookie\s+policy", r"privacy\s+policy", r"terms\s+of\s+service", r"subscribe\s+to\s+newsletter",
    r"sign\s+up\s+for", r"advertisement", r"sponsored\s+content", r"accept\s+cookies", r"gdpr",
    r"we\s+use\s+cookies",
)
WORDS_ID = ("dan", "atau", "yang", "untuk", "dengan", "dari", "di", "ke", "adalah", "ini", "itu")
WORDS_EN = ("the", "and", "or", "for", "with", "from", "to", "in", "on", "is", "this", "that")
LANGUAGE_WINDOW = 200
MIN_PARAGRAPH = 50
SCHEMA_ITEMTYPE = r"""itemtype=["']https?://schema\.org/"""
SCHEMA_JSONLD = r'"@type"\s*:\s*"'

# Gates.
TEXT_NOISE = (
    r"\bfunction\s+\w+\s*\(",
    r"\bvar\s+\w+\s*=",
    r"\bconst\s+\w+\s*=",
    r"\blet\s+\w+\s*=",
    r"\{[\s]*[a-z-]+[\s]*:[\s]*[a-z0-9#]",
    r"cookie\s+(policy|consent|settings|preferences)",
    r"accept\s+(all\s+)?cookies",
)
MAX_TEXT_NOISE = 3
GATE_TEXT_EMPTY = "Text is empty after extraction"
GATE_TEXT_NOISE = "ZeroNoiseAssertionGate (text): %d noise patterns detected"
GATE_OPEN = "XML: missing <extraction_result> opening tag"
GATE_CLOSE = "XML: missing </extraction_result> closing tag"
GATE_BODY_OPEN = "XML: missing <main_body> opening tag"
GATE_BODY_CLOSE = "XML: missing </main_body> closing tag"
GATE_MALFORMED = "XML: malformed <main_body>"
GATE_BODY_EMPTY = "XML: <main_body> is empty"
GATE_NO_HEADING = "ZeroNoiseAssertionGate (XML): <main_body> has no Markdown heading"

# Formats.
BOUNDARY = (
    "<extraction_result>\n  <metadata>\n  Title: %s\n  URL: %s\n  Timestamp: %s\n  </metadata>\n\n"
    "  <main_body>\n%s\n  </main_body>\n</extraction_result>\n"
)
BOUNDARY_LOW = (
    "<extraction_result>\n  <metadata>\n  Title: %s\n  URL: %s\n  </metadata>\n\n"
    "  <main_body>\n%s\n  </main_body>\n</extraction_result>\n"
)
ERR_NO_PAGE = "Failed to open tab"
ERR_ANTI_BOT = "Anti-bot challenge detected (%s)"
ERR_EMPTY = "Empty content extracted (%d chars) — page may be JS-rendered or blocked"
ERR_EMPTY_CACHED = "Empty content extracted (%d chars)"
ERR_LOW = "Low content (%d chars) — returned what's available"
PIPELINE_FULL = "map->score->prune->validate->text->iframe->md->wrap"
PIPELINE_CACHED = "cached_structure->text->iframe->md->wrap"
EXTRACTOR = "webwinnow"
STRUCTURE_TTL_HOURS = 168
REQUEST_CAP, REQUEST_CAP_DIGEST = 5, 3
SEARCH_DEFAULT, SEARCH_MAX = 5, 20
NO_RESULTS = "No results found."

# Token markers (Unicode noncharacters, which cannot be page text): the page
# scan writes them, functions/dom.py and functions/markdown.py resolve them.
# Groups that a pattern tests together are contiguous.
T_BLOCK, T_PARA, T_BR, T_CELL, T_ROW, T_TABLE, T_NEWLINE = (
    "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4", "\ufdd5", "\ufdd6",
)
T_HIDE, T_SHOW, T_SPACE, T_TAB = "\ufdd7", "\ufdd8", "\ufdd9", "\ufdda"
M_PARA, M_LINE, M_LIST, M_BREAK, M_ITEM = "\ufddb", "\ufddc", "\ufddd", "\ufdde", "\ufddf"
M_OPEN, M_CLOSE, M_END, M_STOP = "\ufde0", "\ufde1", "\ufde2", "\ufde3"
T_HELD = "\ufde4"
