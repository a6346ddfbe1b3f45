import pytest

from plaintlens.functions import text as T
from plaintlens.operators import normalize


@pytest.mark.parametrize(
    "text, gone, kept",
    [
        ("Visit our site: http://example.com now", ["http", "example"], ["visit our site", "now"]),
        ("Call me at 555-1234 please", ["555", "1234"], ["call me at please"]),
        ("call 5551234567 ok", ["555"], ["call ok"]),
        ("I hate the <br>high fees", ["br"], ["high fees"]),
        ("My account XXXX was charged on XX/XX/2024", ["xx"], ["my account", "2024"]),
        ("Fee of $50.00!! Why??", ["$", "!", "?", "."], ["fee of 5000 why"]),
        ("iban gb1234567890123 here", ["gb12"], ["iban here"]),
        ("credit/debit card", ["/"], ["creditdebit card"]),
        ("the exxon station", ["exxon"], ["the eon station"]),
        ("Déjà vu à l'été", ["'"], ["déjà vu à lété"]),
        ("a_b  c\t\n d e", ["  "], ["a_b c d e"]),
        ("call 555-123-4567", ["123", "4567"], ["call 555"]),
        ("é5551234 x", [], ["é5551234 x"]),
    ],
)
def test_noise(apply, text, gone, kept):
    [out] = apply(T.clean_noise, [text])
    assert all(g not in out for g in gone), out
    assert all(k in out for k in kept), out


def test_noise_empty_inputs(apply):
    assert apply(T.clean_noise, [None, "", "  \n　", "nan", "NaN", "!!!"]) == [""] * 6


def test_long_phone_first_is_an_option(apply):
    assert apply(lambda c: T.clean_noise(c, "long_first"), ["call 555-123-4567 now"]) == ["call now"]


@pytest.mark.parametrize(
    "text, out",
    [
        (
            "to whom it may concern, i am writing to file a complaint about fraud on my account.",
            "fraud on my account.",
        ),
        ("i'm writing to lodge a complaint regarding fees", "fees"),
        ("i would like to file a complaint about identity theft", "identity theft"),
        ("this letter is to notify you of an error", "of an error"),
        ("i am filing this complaint against the bank", "the bank"),
        # the connector has no closing word boundary
        ("i am writing to inform your bank", "r bank"),
        # not at the start
        ("the bank told me to file a complaint but never followed up.",) * 2,
        ("i am writing to file a complaints list",) * 2,
        ("   to whom it may concern:\n hello ", "hello"),
        ("it is fine", "it is fine"),
    ],
)
def test_openers(apply, text, out):
    assert apply(T.strip_openers, [text]) == [out]


def test_openers_stop_after_three_rounds(apply):
    text = "to whom it may concern, " * 4 + "hello"
    assert apply(T.strip_openers, [text]) == ["to whom it may concern, hello"]


def test_opener_search(apply):
    texts = ["I am writing to you", "  TO WHOM IT MAY CONCERN", "the writing", None]
    assert apply(T.has_opener, texts) == [True, True, False, False]


def test_normalize(apply):
    texts = ["the app keeps crashing", "i cannot pay the fees", "we were charged", ""]
    assert apply(T.normalize, texts) == ["app keep crash", "pay fee", "charge", ""]
    texts = ["gonna gotta", "gimme lemme wanna", "cannot", "xcannot cannotx", "a  fees "]
    assert apply(T.normalize, texts) == [
        "gon na get ta", "gim lem wan na", "", "xcannot cannotx", "fee",
    ]


def test_full_clean(apply):
    text = "To Whom It May Concern: the app KEEPS crashing!! See www.x.example"
    assert apply(T.clean_text, [text]) == ["app keep crash see"]


def test_word_count_splits_on_unicode_space(apply):
    texts = ["a b c\x1cd", " ", "one", None]
    assert apply(T.word_count, texts) == [4, 0, 1, None]


@pytest.mark.parametrize("limit", [normalize.MAX_LITERAL_ENTRIES, 0])
def test_lexicon_table_agrees_with_literal_lexicon(spark, monkeypatch, limit):
    monkeypatch.setattr(normalize, "MAX_LITERAL_ENTRIES", limit)
    rows = [(1, "charged cards twice"), (2, "nothing here"), (3, ""), (4, "charged gotta charged"), (5, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    lexicon = spark.createDataFrame(
        [*T.seed_lexicon(), ("charged", "v", "zzz")], "surface string, pos string, lemma string"
    )
    by_table = normalize.normalize_with_table(df, "id", "t", lexicon)
    assert {r.id: r.normalized for r in by_table.collect()} == {
        1: "charge card twice", 2: "nothing", 3: "", 4: "charge get ta charge", 5: "",
    }


def test_verb_lemma_then_noun_lemma(spark, apply):
    lexicon = [("leaves", "v", "leafs"), ("leafs", "n", "leaf")]
    assert apply(lambda c: T.normalize(c, lexicon), ["leaves leafs"]) == ["leaf leaf"]
