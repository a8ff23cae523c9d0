"""Values that results depend on, stated once."""

# --- Fixed values -----------------------------------------------------------

# Sentiment classes: id -> name, in class order.
SENTIMENTS = {
    0.0: "Negative",
    1.0: "Neutral",
    2.0: "Positive",
}

# Star ratings belonging to each class.
RATINGS_BY_CLASS = {
    0.0: (1.0, 2.0),
    1.0: (3.0,),
    2.0: (4.0, 5.0),
}

# Domain words that are never keywords: the short list.
CUSTOM_STOPWORDS = (
    "phone mobile cellphone amazon product device item thing stuff use one"
).split()

# Domain words that are never keywords: the long list.
CANONICAL_STOPWORDS = (
    "day days time money work one two three year years "
    "month months week weeks people thing things number price "
    "shipping case screen battery product device app apps system "
    "software feature features use used using buy bought phone "
    "mobile cellphone amazon card unlocked sim seller good new "
    "apple iphone display charger bluetooth wifi network payment "
    "credit delivery"
).split()

# The default English list of pyspark.ml.feature.StopWordsRemover.
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now "
    "i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's "
    "she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't "
    "hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't "
    "cannot could here's how's let's ought that's there's what's when's where's who's why's would"
).split()

# Model settings.
FEATURE_WIDTH = 8000
HASHING_ITERATIONS = 30
VOCABULARY_ITERATIONS = 1500
TRAIN_SHARE = 0.8
SEED = 42

# Report settings.
TOP_WORDS = 15
CHART_WORDS = 10
MIN_CLEAN_LENGTH = 5
MIN_KEYWORD_LENGTH = 2
KEYWORD_POS = ("ADJ", "NOUN")

# The reason given with a request that has no words.
EMPTY_TEXT = "Input text is empty after cleaning."

# ----------------------------------------------------------------------------

UNKNOWN_SENTIMENT = "Unknown"
DOMAIN_STOPWORDS = {"custom": CUSTOM_STOPWORDS, "canonical": CANONICAL_STOPWORDS}
