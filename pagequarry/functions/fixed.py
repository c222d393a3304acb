"""Fixed values. Results depend on each of them being exactly as stated."""

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# English stop words dropped from queries (127).
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are was "
    "were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both "
    "each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now"
).split()

# Stop words of the text index (34); tokens of one character are dropped too.
INDEX_STOP_WORDS = (
    "a an and are as at be by can for from have if in is it may not of on or "
    "tbd that the this to us we when will with yet you your"
).split()

# Links holding one of these are site resources, not pages.
RESOURCE_MARKS = ["/w/", "/mw/", "/wiki/Special:"]

# The other list of resource marks.
RESOURCE_MARKS_CMS = ["/common/", "/commonspot/", "./"]

# Query parameters that do not change the page.
VOLATILE_PARAMETERS = ["mobileaction", "returnto", "returntoquery", "?title", "redlink"]

# The path every robots rule set starts with.
ROBOTS_EXTRA_PATH = "/wiki/?title=Special:"

# BM25 parameters and the weights of the blended score.
BM25_B = 0.75
BM25_K1 = 1.2
BLEND_ALPHA = 0.3
BLEND_RANK_SCALE = 0.05

# PageRank damping and number of rounds.
DAMPING = 0.9
ROUNDS = 20

# Sizes of the text steps and of the result lists.
SNIPPET_LENGTH = 200
WORDS_PER_LINE = 20
KEEP_LONGER_THAN = 1500
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 500
HITS_PER_QUERY = 100
HITS_PER_PAGE = 10
RELATED_PER_WORD = 5
CHUNKS_PER_QUESTION = 3
ANSWER_THRESHOLD = 0.7

# Prompt, context separator and refusal.
CONTEXT_SEPARATOR = "\n\n---\n\n"
PROMPT_TEMPLATE = """
Answer the question based only on the following context:

{context}

---

Answer the question based on the above context: {question}

In your response, do not start with "based on the context..." or similar phrases, simply answer the question with confidence.
"""
REFUSAL_TEMPLATE = "No response could be made for the inquiry {question}."
