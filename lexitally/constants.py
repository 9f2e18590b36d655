"""Labels, word lists, keyword tables, weights and formats.

Everything here is configuration that decides results; functions take these as
parameter defaults so that another corpus can bring its own.
"""

# Label domain and the states a vote can leave a post in.
LABELS = ["negative", "neutral", "positive"]
BINARY_LABELS = ["negative", "non_negative"]
INVALID = "invalid"
REVIEW_STATES = ["needs_review", "manual_review", "invalid_label"]
MIN_VALID_VOTES = 3
RATERS = ["annotator_1", "annotator_2", "annotator_3", "annotator_4"]

# Default English function words. The list is a parameter everywhere it is used.
ENGLISH_STOP_WORDS = (
    "a about above after again all also am an and any are as at be because been "
    "before being below between both but by can could did do does doing down "
    "during each few for from further had has have having he her here hers "
    "herself him himself his how i if in into is it its itself me more most my "
    "myself no nor not now of off on once only or other our ours ourselves out "
    "over own same she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up "
    "very was we were what when where which while who whom why will with would "
    "you your yours yourself yourselves"
).split()

# Markup tokens that survive cleaning, and what is left of contractions once
# their apostrophes are gone.
ARTIFACT_TOKENS = ["href", "rel", "nofollow", "p"]
CONTRACTION_FRAGMENTS = ["s", "t", "re", "ve", "ll", "d", "m"]
TOPIC_STOP_WORDS = sorted({*ENGLISH_STOP_WORDS, *ARTIFACT_TOKENS, *CONTRACTION_FRAGMENTS})

# Non-content tokens left out of the discriminative-term tables.
NOISE_TOKENS = [
    "href", "rel", "nofollow", "noreferrer", "http", "https", "www",
    "com", "org", "html", "amp", "gt", "lt", "quot",
    "don", "isn", "didn", "doesn", "wasn", "aren", "won", "couldn",
    "wouldn", "shouldn", "hasn", "haven",
    "ll", "ve", "re",
]
KEYWORD_STOP_WORDS = sorted({*ENGLISH_STOP_WORDS, *NOISE_TOKENS})

# Tokens and exact pairs kept out of report tables of frequent bigrams.
BIGRAM_NOISE_TOKENS = [
    "href", "rel", "nofollow", "http", "https", "www", "com", "amp", "nbsp",
    "is", "are", "was", "were", "be", "been", "being", "am", "the", "a", "an",
    "of", "to", "in", "on", "for", "with", "and", "or", "if", "it", "this",
    "that", "they", "you", "we", "he", "she", "as", "by", "from", "at",
]
BIGRAM_NOISE_EXACT = [
    "this is", "in the", "of the", "to be", "is the", "on the", "if you",
    "it is", "is it", "you re", "they are", "how does", "are not", "is not",
    "would be", "for the", "and the", "from the", "with the", "at the",
    "by the", "as the", "that is", "there is", "there are",
]

# The keywords of each topic, and those that count as whole words only.
TOPIC_KEYWORDS = {
    "Artificial Intelligence": ["ai", "chatgpt", "openai", "llm", "machine learning", "neural", "gpt"],
    "Cryptocurrency": ["bitcoin", "crypto", "ethereum", "blockchain", "btc", "eth"],
    "Climate Change": ["climate", "warming", "carbon", "emission", "renewable", "fossil"],
    "Cybersecurity": [
        "cybersecurity", "ransomware", "malware", "data breach", "cyber attack",
        "hacker", "phishing", "vulnerability", "exploit",
    ],
}
WHOLE_WORD_KEYWORDS = ["ai", "eth", "btc", "gpt", "llm", "wfh", "neural"]
MIN_KEYWORD_HITS = 1

# Collection windows, newest first: (name, start, end) in epoch seconds, both
# ends exclusive.
TIME_WINDOWS = [
    ("Q2-2026", 1775001600, 1783065600),
    ("Q1-2026", 1767225600, 1775001600),
    ("Q4-2025", 1759276800, 1767225600),
    ("Q3-2025", 1751328000, 1759276800),
    ("Q2-2025", 1743465600, 1751328000),
    ("Q1-2025", 1735689600, 1743465600),
    ("Q4-2024", 1727740800, 1735689600),
    ("Q3-2024", 1719792000, 1727740800),
    ("Q2-2024", 1711929600, 1719792000),
    ("Q1-2024", 1704067200, 1711929600),
    ("Q4-2023", 1696118400, 1704067200),
    ("Q3-2023", 1688169600, 1696118400),
    ("Q2-2023", 1680307200, 1688169600),
    ("Q1-2023", 1672531200, 1680307200),
]
MAX_HITS_PER_QUERY = 8
TOPIC_TARGET = 300

# Length bounds: collection keeps 5..12 words and >= 5 characters, cleaning 6..12.
COLLECT_MIN_CHARS = 5
COLLECT_MIN_WORDS = 5
CLEAN_MIN_WORDS = 6
MAX_WORDS = 12

# Display names for reports.
LABEL_DISPLAY = {"negative": "Αρνητικό", "neutral": "Ουδέτερο", "positive": "Θετικό"}
TOPIC_DISPLAY = {
    "Artificial Intelligence": "Τεχνητή Νοημοσύνη",
    "Climate Change": "Κλιματική Αλλαγή",
    "Cryptocurrency": "Κρυπτονομίσματα",
    "Cybersecurity": "Κυβερνοασφάλεια",
}
QUARTER_DISPLAY = {1: "Ιαν–Μαρ", 2: "Απρ–Ιουν", 3: "Ιουλ–Σεπ", 4: "Οκτ–Δεκ"}
DISCRIMINATIVE = "διακριτική"
MERELY_FREQUENT = "απλώς συχνή"

# Vocabulary pruning and table sizes.
MIN_DF = 2
MAX_DF = 0.9
TOP_TERMS = 20
TOP_BIGRAMS = 30
TOP_BIGRAMS_PER_CLASS = 15
TOP_KEYWORDS = 15
UNIGRAM_KEYWORD_MIN_DF = 3
BIGRAM_KEYWORD_MIN_DF = 2
SPREAD_THRESHOLD = 1.0

# Custom scoring weights.
MIN_TERM_COUNT = 2
TERM_WEIGHTS = {
    "freq_score": 0.20,
    "tfidf_score": 0.25,
    "topic_specific_score": 0.20,
    "sentiment_association_score": 0.15,
    "positional_score": 0.10,
    "bigram_boost_score": 0.10,
}
BIGRAM_WEIGHTS = {"bigram_tfidf_score": 0.70, "bigram_distinctiveness": 0.30}
DOCUMENT_WEIGHTS = {"unigram_score": 0.55, "bigram_score": 0.30, "positional_score": 0.15}

# Learning.
SEED = 42
TEST_SIZE = 0.2
FOLDS = 5
NEIGHBOURS = 5
TOPIC_TREES = 100
LABEL_TREES = 300
LATENT_TOPICS = 4
LDA_ITERATIONS = 30
NMF_ITERATIONS = 300
ALPHA = 0.05
FEW_TEST_ROWS = 10
NGRAM_RANGES = {"unigrams_only": (1, 1), "bigrams_only": (2, 2), "unigrams_plus_bigrams": (1, 2)}
