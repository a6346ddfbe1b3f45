"""Fixed values. They decide results, so they are stated as plain text in one place."""

# --- fixed values: product labels -> the four categories ---------------------------------
PRODUCT_MAP = {
    "Credit Card": [
        "Credit card",
        "Credit card or prepaid card",
    ],
    "Personal Loan": [
        "Payday loan, title loan, or personal loan",
        "Payday loan, title loan, personal loan, or advance loan",
        "Consumer Loan",
        "Payday loan",
    ],
    "Savings Account": [
        "Bank account or service",
        "Checking or savings account",
    ],
    "Money Transfer": [
        "Money transfers",
        "Money transfer, virtual currency, or money service",
    ],
}
VALID_CATEGORIES = ["Credit Card", "Money Transfer", "Personal Loan", "Savings Account"]

# --- fixed values: stock openers, matched at the start of lower-cased text ----------------
OPENER_PATTERNS = [
    r"^\s*i\s*(?:'m|am)\s+writing\s+to\s+(?:file|submit|lodge|report)\s+a\s+complaint\b"
    r"(?:\s+(?:about|regarding|concerning))?\s*",
    r"^\s*i\s+am\s+writing\s+(?:this\s+letter\s+)?to\s+(?:express|inform|report|notify)\b"
    r"(?:\s+(?:you|my|about|regarding|concerning))?\s*",
    r"^\s*i\s+would\s+like\s+to\s+file\s+a\s+complaint\b"
    r"(?:\s+(?:about|regarding|concerning))?\s*",
    r"^\s*this\s+letter\s+is\s+to\s+(?:inform|notify|report)\b"
    r"(?:\s+(?:you|about|regarding|concerning))?\s*",
    r"^\s*to\s+whom\s+it\s+may\s+concern[,:]?\s*",
    r"^\s*i\s+am\s+filing\s+(?:this\s+)?complaint\s+against\b\s*",
]
OPENER_PASSES = 3
OPENER_SEARCH = r"^\s*(?:i am writing to|i'm writing to|to whom it may concern)"

# --- fixed values: Unicode white space as Python's str.strip / split see it ---------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: English stop words without an apostrophe -------------------------------
# (cleaned text has no apostrophes, so the other entries of the usual list can never match)
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now d ll m o re
ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
weren won wouldn
""".split()

# --- fixed values: words the tokenizer splits in two --------------------------------------
SPLIT_WORDS = ["can|not", "gim|me", "gon|na", "got|ta", "lem|me", "wan|na"]

# --- fixed values: seed lemma lexicon "pos lemma: surface forms" --------------------------
# A seed only: pass a full lexicon table to the normaliser for complete coverage.
SEED_LEXICON_TEXT = """
v charge: charges charged charging
v crash: crashes crashed crashing
v pay: pays paid paying
v send: sends sent sending
v close: closes closed closing
v call: calls called calling
v tell: tells told telling
v say: says said saying
v receive: receives received receiving
v refuse: refuses refused refusing
v deny: denies denied denying
v dispute: disputes disputed disputing
v report: reports reported reporting
v open: opens opened opening
v transfer: transfers transferred transferring
v apply: applies applied applying
v make: makes made making
v get: gets got gotten getting
v go: goes went gone going
v take: takes took taken taking
v give: gives gave given giving
v keep: keeps kept keeping
v use: uses used using
v try: tries tried trying
v ask: asks asked asking
v owe: owes owed owing
v lose: loses lost losing
v hold: holds held holding
v rest: rests rested resting
v hear: hears heard hearing
v enter: enters entered entering
v read: reads reading
v ring: rings rang rung ringing
v heat: heats heated heating
v hand: hands handed handing
n account: accounts
n card: cards
n fee: fees
n payment: payments
n loan: loans
n bank: banks
n customer: customers
n complaint: complaints
n statement: statements
n balance: balances
n month: months
n day: days
n year: years
n company: companies
n letter: letters
n number: numbers
n thing: things
n one: ones
n stone: stones
n shore: shores
"""

# --- fixed values: chunking, sampling, retrieval, scoring ---------------------------------
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
SEPARATORS = ["\n\n", "\n", ". ", " ", ""]
SWEEP_CANDIDATES = [(250, 25), (500, 50), (1000, 100)]
SAMPLE_SIZE = 12_500
SAMPLE_SEED = 42
CATEGORY_CAP = 150
EMBEDDING_DIM = 384
TOP_K = 5
MAX_QUESTION_CHARS = 1000
FAITHFULNESS_TARGET = 0.85
FAITHFUL_SCORE = 4
MAX_ATTEMPTS = 3
BACKOFF_BASE_SECONDS = 1.5
MAX_NEW_TOKENS = 300
JUDGE_MAX_TOKENS = 150
LOW_SIMILARITY = 0.2
CATEGORY_CANDIDATE_KEYS = ["product", "product_category", "Product", "category"]
METADATA_INT_FIELDS = ["chunk_index", "total_chunks"]

# --- fixed values: messages and prompt templates ------------------------------------------
NO_CONTEXT_MESSAGE = (
    "I couldn't find any relevant complaints for that question. "
    "Try rephrasing it, choosing a different product category, or "
    "asking about one of the four supported products (Credit Card, "
    "Personal Loan, Savings Account, Money Transfer)."
)
ANSWER_FAILURE_MESSAGE = (
    "I'm having trouble reaching the answer-generation service right now. "
    "Please try again in a moment. If this keeps happening, the retrieved "
    "sources below are still a good starting point."
)
NO_CONTEXT_FOR_JUDGE = "(no context retrieved)"
NOT_ENOUGH_INFORMATION = "I don't have enough information"

# {organisation} is the caller's own name; {context} and {question} come from the data.
ANSWER_TEMPLATE = """You are a financial analyst assistant for {organisation}. \
Your task is to answer questions about customer complaints.
Use ONLY the following retrieved complaint excerpts to formulate your answer.
If the context doesn't contain enough information to answer the question, \
state clearly: "I don't have enough information to answer that."
Do not add any information not present in the excerpts below.

Retrieved complaint excerpts:
{context}

Question: {question}

Answer:"""
DEFAULT_ORGANISATION = "a financial services company"

JUDGE_TEMPLATE = """You are a strict, impartial evaluator scoring a RAG \
(Retrieval-Augmented Generation) system for a financial complaints chatbot.

Question asked by the user:
{question}

Retrieved complaint excerpts given to the system as context:
{context}

Answer generated by the system:
{answer}

Score the answer on exactly two dimensions, each from 1 (worst) to 5 (best):

1. retrieval_relevance: Are the retrieved excerpts actually relevant to the \
question? (5 = highly relevant and on-topic, 1 = irrelevant/off-topic)
2. faithfulness: Does the answer stay strictly grounded in the retrieved \
excerpts, with no invented facts, numbers, or claims not supported by the \
context? (5 = fully grounded, 1 = largely fabricated or unsupported)

Respond with ONLY a single JSON object, no other text, in exactly this form:
{"retrieval_relevance": <int 1-5>, "faithfulness": <int 1-5>, "comment": "<one sentence justification>"}
"""
