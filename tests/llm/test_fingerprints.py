"""Fingerprints against a Merkle tree built node by node."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from postbud.llm import fingerprints

TEXTS = [
    "", " ", "\n", "\n\n", "a", "a ", " a", "a\n", "a\nb", "a\n\nb", "One two. Three four! Five?\nSix.", "x" * 200, "y" * 64 + " z",
    "a  b", "a\tb. c", "é. ü ", "one two three four five six seven eight nine ten", "a. b\n\n\nc. d\n", "..", ". . .", "\ttab\t",
]


def pieces(paragraph):
    out = []
    for sentence in re.split(r"(?<=[.!?])(?=[ \t\n\v\f\r])", paragraph):
        words = re.findall(r"[ \t\n\v\f\r]*[^ \t\n\v\f\r]{1,64}|[ \t\n\v\f\r]+", sentence)
        run = []
        for word in words:
            blank = not word.strip(" \t\n\v\f\r")
            # A word that is cut at 64 characters goes on in a piece of its own.
            if run and (blank or len(run) == fingerprints.PIECE_WORDS or not word[0].isspace() and word[0] not in " \t"):
                out.append("".join(run))
                run = []
            run.append(word)
            if blank:
                out.append("".join(run))
                run = []
        if run:
            out.append("".join(run))
    return out


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def plain_tree(text):
    sections, section = [], []
    for paragraph in text.split("\n"):
        own = pieces(paragraph)
        assert "".join(own) == paragraph
        leaves = [md5(p) for p in own]
        node = md5("p" + "".join(leaves))
        section.append((node, leaves))
        if not leaves or node[0] in "048c":
            sections.append(section)
            section = []
    if section:
        sections.append(section)
    hashes = [md5("s" + ",".join(node for node, _ in s)) for s in sections]
    root = hashlib.sha256("".join(hashes).encode()).hexdigest()
    shown = [h[:8] + ":" + ",".join(".".join([node[:8], *[x[:8] for x in leaves]]) for node, leaves in s) for h, s in zip(hashes, sections)]
    return root if not text else "|".join([root, *shown])


def plain_likeness(a, b):
    if a[:64] == b[:64]:
        return 1.0
    x, y = (set(re.findall(r"\.([0-9a-f]{8})", p)) for p in (a, b))
    n = len(x) + len(y)
    return min(2 * len(x & y) / n, 1 - 1 / (n + 1)) if n else 0.0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    alphabet = ["a", "bb", "ccc.", "d!", " ", "  ", "\n", "\t", "é", "z" * 70, "? "]
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]


def test_every_node_is_made_from_its_children(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fingerprints.fingerprint(F.col("text")).alias("f"))
    assert [r["f"] for r in rows.orderBy("i").collect()] == [plain_tree(t) for t in texts]
    roots = {}
    for t in texts:
        assert roots.setdefault(plain_tree(t)[:64], t) == t


def test_query_against_a_plain_version(spark, texts):
    docs = spark.createDataFrame([(i * 3, t or None) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        after = texts[i - 1]  # descending doc_id; the first after the last
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        r, own, new = got[i * 3], plain_tree(text), plain_tree(edit)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, new)
        assert r["near_edited"] == pytest.approx(plain_likeness(own, new))
        assert r["near_next"] == pytest.approx(plain_likeness(own, plain_tree(after)))
