"""Small inputs and brute-force versions that the tests share."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it ü é ñ".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))


def prose(rng, n):
    return " ".join(word(rng) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def documents(spark, texts, **columns):
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    """Null, empty, blank, symbols only, one word, repeated, long and multi-byte texts."""
    rng = random.Random(1)
    return [None, "", " \t\n\x0b ", "### *** ###", "word", "same same same same same same", prose(rng, 3000), "ü" * 5000, "日本語 テキスト です", "a\n\nb\na\n", prose(rng, 40), prose(rng, 40)]


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOWER))


def shingle_set(text, n=5):
    w = plain_words(text)
    return {tuple(w[i : i + min(n, len(w))]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = word(rng)
    return " ".join(words)
