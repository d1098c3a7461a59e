"""Fixed values.

Everything in this module is data, not logic: lists and tables whose exact
content decides results. They are stated once, in natural order.
"""

# --- fixed values: English stopwords -------------------------------------------
# Spark ML's default English list (StopWordsRemover.loadDefaultStopWords("english")),
# 181 words, written out so oracle SQL and tests can use it without a JVM.
STOPWORDS_EN = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her",
    "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where",
    "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", "would",
]

# --- fixed values: crypto keyword dictionary (symbol -> words, lower case) ------
# The effective tagging dictionary: every word is compared with a lowered,
# symbol-free word of cleaned text. Multi-word names are kept for n-gram search.
CRYPTO_KEYWORDS = {
    "BTC": ["bitcoin", "btc", "satoshi", "₿"],
    "ETH": ["ethereum", "eth", "ether", "ξ"],
    "BNB": ["binance coin", "bnb"],
    "SOL": ["solana", "sol"],
    "LTC": ["litecoin", "ltc"],
    "LINK": ["chainlink", "link"],
    "MATIC": ["polygon", "matic"],
    "ADA": ["cardano", "ada"],
}

# --- fixed values: general crypto / sentiment words (lower case) ---------------
GENERAL_KEYWORDS = [
    "crypto", "cryptocurrency", "blockchain", "defi", "nft", "altcoin",
    "stablecoin", "hodl", "fomo", "fud", "bullish", "bearish", "pump", "dump",
    "moon", "rekt",
]

# Search-only terms (used to find items, never to tag them).
SEARCH_ONLY_KEYWORDS = {"DOT": ["polkadot", "dot"]}

# --- fixed values: classifier label names --------------------------------------
CLASSIFIER_LABELS = {"LABEL_0": -1, "LABEL_1": 1}
LABEL_WORDS = {-1: "negative", 1: "positive"}
LABEL_WORD_DEFAULT = "unknown"

# --- fixed values: test dictionary over the driver's invented prose ------------
# (frequent non-stopwords of the synthetic documents; stands in for coin names)
TEST_KEYWORDS = {
    "ALPHA": ["ing", "ther"],
    "BETA": ["ble"],
    "GAMMA": ["tion", "thon"],
}
TEST_GENERAL = ["thth", "thre"]

# --- fixed values: test sentiment lexicon over the invented prose ---------------
TEST_LEXICON = {
    "der": 1.0, "die": 1.0, "und": 1.0, "que": 1.0, "thha": 1.0,
    "les": -1.0, "sch": -1.0, "den": -1.0, "von": -1.0, "thea": -1.0,
}

# --- fixed values: forum-like source list for membership filters --------------
TEST_SOURCES = ["src1", "src3", "src5", "src7", "src11", "src13"]

# Regex classes (Java and RE2 accept both). Word characters follow the Unicode
# meaning of \w: letters, numbers, underscore. Whitespace follows Python's
# str.split(): Unicode separators, ASCII whitespace incl. \x0b, \x1c-\x1f, \x85.
WS_CLASS = r"\p{Z}\s\x0b\x1c-\x1f\x{85}"
WORD_CLASS = r"\p{L}\p{N}_"
URL_PATTERN = r"http\S+"
SYMBOL_PATTERN = "[^" + WORD_CLASS + WS_CLASS + "]"
SPLIT_PATTERN = "[" + WS_CLASS + "]+"

# --- fixed values: test search list (single and multi-word) ---------------------
TEST_SEARCH_KEYWORDS = ["ing", "ther", "ble", "tion", "thon", "thth", "thre",
                        "eriner thanea", "attion to", "de la"]
