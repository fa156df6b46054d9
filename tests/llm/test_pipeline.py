"""The whole pipeline against plain versions of its stages, each on its own predecessor's plain result."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from postbud.llm import language, mixing, near_dup
from tests.llm.test_operators import brute_force, plain_grams, plain_models, shingle_set, words

ALPHABETS = {"p": "abcdeé", "q": "cdefgh", "r": "ghijkà", "s": "abghxy"}
BLANK = " \t\n\v\f\r"


def make_documents():
    """Rows (doc_id, text, lang, source): clean ones, near copies, repeated lines, benchmark passages, other scripts, odd ones."""
    rng, rows = random.Random(3), []
    items = [(i, words(9000 + i, 26, ALPHABETS["pqrs"[i % 4]]) + ". " + words(9100 + i, 4, "abc") + ".") for i in range(8)] + [(40, None)]
    lines = [words(9200 + i, 12, ALPHABETS["pqrs"[i % 4]]) for i in range(6)]
    for i in range(160):
        lang = "pqrs"[i % 4]
        text = words(8000 + i, 70 + i % 30, ALPHABETS[lang])
        if i % 5 == 0:
            text += "\n" + lines[i % 6].upper() + " \n" + words(8400 + i, 20, ALPHABETS[lang])
        if i % 23 == 0:
            text += " " + items[i % 8][1] + " " + words(8600 + i, 30, ALPHABETS[lang])
        rows.append((i, text, lang if i % 9 else None, f"s{i % 4}" if i % 3 else "s0" if i % 2 else None))
    for i in range(60):
        original = rows[(i * 7) % 40]
        copy = original[1].split(" ")
        for at in rng.sample(range(10, 60), i % 3):
            copy[at] = f"abc{i}"
        rows.append((500 + i, " ".join(copy) if i % 3 else original[1], original[2], "s2"))
    rows += [(900 + i, "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(120)), None, "s1") for i in range(4)]
    return [*rows, (950, None, None, "s1"), (951, "", "p", "s1"), (952, "12 34\n--", None, None)], items


def crc(text):
    return zlib.crc32(text.encode())


def recognised(rows):
    sample = [(i, t, x) for i, t, x, _ in rows if t is not None and x is not None and crc(str(i)) % 4 != 2]
    learnt = {x: [t for i, t, y in sample if x == y and crc(f"hold:{i}") % 5] for x in sorted({x for _, _, x in sample})}
    models = plain_models(learnt)

    def predict(text):
        grams = plain_grams(text)
        entropy = {x: -sum(math.log2(p(g)) for g in grams) / len(grams) for x, p in models.items()}
        best = min(entropy, key=entropy.get)
        return best, entropy[best], len(grams)

    spread = {}
    for i, t, x in sample:
        if crc(f"hold:{i}") % 5 == 0 and re.search(r"[^\W\d_]", t) and predict(t)[0] == x:
            spread.setdefault(x, []).append(predict(t)[1])
    limits = {}
    for x, values in spread.items():
        middle, high = (sorted(values)[max(math.ceil(q * len(values)), 1) - 1] for q in (0.5, 0.995))
        limits[x] = high + max(language.SLACK * (high - middle), 1.0)
    kept = []
    for row in rows:
        if row[1] and re.search(r"[^\W\d_]", row[1]):
            best, entropy, n = predict(row[1])
            if entropy <= limits.get(best, math.inf) + 4 / math.sqrt(n):
                kept.append(row)
    return kept


def without_lines(rows):
    key = lambda line: line.strip(BLANK).encode().lower()
    holders = {}
    for row in rows:
        for line in row[1].split("\n"):
            if len(line.strip(BLANK)) >= 40:
                holders.setdefault(key(line), set()).add(row[0])
    gone = lambda line, i: len(holders.get(key(line), ())) >= 5 and max(holders[key(line)]) != i
    return [(i, "\n".join(x for x in t.split("\n") if not gone(x, i)), *rest) for i, t, *rest in rows]


def one_of_each_class(rows):
    sets = {row[0]: shingle_set(row[1]) for row in rows}
    df = Counter(s for own in sets.values() for s in own)
    rare = near_dup.RARE
    idf = {s: 1 if c <= rare * len(rows) else 0.5 + 0.5 * math.log(len(rows) / c) / math.log(1 / rare) for s, c in df.items()}
    weighted = lambda c: sum(n * idf[s] for s, n in c.items())
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, p in sets.items():
        for b, q in sets.items():
            if a < b and p and q and weighted(p & q) >= near_dup.THRESHOLD * weighted(p | q):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return [row for row in rows if find(row[0]) == row[0]]


def mixed(rows):
    size = {row[0]: len(re.findall(r"[^\x20\x09-\x0D]+", row[1])) for row in rows}
    sources = sorted({row[3] for row in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sources)}
    target, left, open_ = {}, sum(total.values()), set(sources)
    while full := {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * total[s]}:
        target |= {s: 3 * total[s] for s in full}
        open_ -= full
        left = sum(total.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    out = Counter()
    for row in rows:
        rate = target[row[3]] / total[row[3]]
        unit = int(hashlib.md5(f"{mixing.SEED}:{row[0]}".encode()).hexdigest()[:8], 16) / 2**32
        out[row] += math.floor(rate) + (unit < rate - math.floor(rate))
    return +out


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, items = make_documents()
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_has_the_rows_of_plain_stages(spark, sf_dir):
    rows, items = make_documents()
    counts = [len(rows)]
    items = [(i, t or "") for i, t in items if t]
    stages = [
        recognised,
        without_lines,
        one_of_each_class,
        lambda rows: [r for r in rows if r[0] not in {d for d, _ in brute_force([r[:2] for r in rows], items)}],
    ]
    for plain_stage in stages:
        rows = plain_stage(rows)
        counts.append(len(rows))
    # Every stage has something to do: other scripts and odd texts go, near copies, benchmark passages.
    assert counts[0] - counts[1] >= 7 and counts[1] == counts[2] and counts[2] - counts[3] >= 40 and counts[3] - counts[4] >= 3
    found = Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "text", "lang", "source").collect()))
    assert found == mixed(rows)
