import random
import re
from collections import Counter

from plaintlens.llm.quality_rules import Bands, quality_rules

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if twice[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def noise(n, seed=1):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ") for _ in range(n))


def prose(n, seed=1):
    rng = random.Random(seed)
    return " ".join(rng.choice(("the", "cat", "sits", "warm", "on", "mat", "über", "naïve")) for _ in range(n))


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    return {r.doc_id: r for r in quality_rules(df, **kw).collect()}


def test_counts_against_brute_force(spark):
    texts = [
        None, "", " \n\t ", "one", "a b c d " * 9, "x y\n\nx y\r\nx y\n \nz", "#*$%&|<> é 𝄞",
        prose(400), prose(9, 3) + "\n" + prose(400, 5), "same line here\n" * 60, noise(9000), "a " * 5000,
        "ab c d e f g h " * 3 + prose(300, 7), "w" * 50000,
    ]
    rows = run(spark, texts)
    for i, text in enumerate(texts):
        assert tuple(rows[i][c] for c in BASE) == brute(text), i
        assert not (rows[i].kept and rows[i].base_failed)


def test_bands(spark):
    rng = random.Random(4)
    words = [noise(rng.randint(3, 9), i) for i in range(3000)]
    clean = " ".join(rng.choice(words[:400]) for _ in range(3000))
    rows = run(spark, [clean, " ".join(words) * 1, "ab" * 3000 + clean[:300]])
    assert rows[0].kept and rows[0].reason is None
    assert not rows[1].kept and rows[1].reason == "incompressible"
    assert not rows[2].kept and rows[2].reason in ("base", "repetitive", "repetitive chunks")


def test_chunk_limits(spark):
    rng = random.Random(4)
    words = [noise(rng.randint(3, 9), i) for i in range(400)]
    clean = " ".join(rng.choice(words) for _ in range(8000))
    middle = clean[:16384] + noise(12288) + clean[16384:20480]
    rows = run(spark, [middle], bands=Bands(whole=((200, 0.0, 1.0),)))
    assert rows[0].reason == "incompressible chunks" and rows[0].n_high_chunks >= 3


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_noise_at_the_end_and_in_short_texts(spark):
    def base64(n):
        rng = random.Random(n)
        raw = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(n))
        return "\n".join(raw[i : i + 60] for i in range(0, n, 60))[:n]

    rng = random.Random(6)
    words = [noise(rng.randint(2, 8), i).replace(" ", "").lower() for i in range(300)]
    clean = " ".join(rng.choice(words) for _ in range(3000))
    texts = [clean[:4096] + base64(4000), clean[:2000] + base64(2000)]
    texts += [base64(n) for n in (2000, 4000, 4096)] + ["a b c d e f g h i j k l m n o p q r s t " + base64(n) for n in (500, 1000)]
    rows = run(spark, texts + [clean[:n] for n in (1000, 3000, 4095, 4097, 9000)])
    assert [rows[i].base_failed for i in range(len(rows))] == [False] * len(rows)
    assert [rows[i].kept for i in range(len(rows))] == [False] * len(texts) + [True] * 5
