"""Hard negatives, token alignment and URL rules against plain versions."""

import hashlib
import json
import math
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from postbud.llm import align, hard_negatives, queries, url_filter
from postbud.llm.tokens import PRINTABLE
from tests.compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
UNWANTED = ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_url_filter"])
def test_query_against_sql(spark, name):
    df = queries.queries()[name](spark, SF_DIR)
    assert difference(spark_rows(df), duck_rows(connect(SF_DIR), queries.oracle_sql()[name])) is None


# ---- token alignment


def plain_alignment(texts):
    """Straight from the contract, one token at a time."""
    path_a, path_b = align.default_files()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    others = iter(range(256, 512))
    byte_of = {chr(x) if x in PRINTABLE else chr(next(others)): x for x in range(256)}
    with open(path_a, encoding="utf-8") as f:
        name_of = {i: t for t, i in json.load(f)["model"]["vocab"].items()}

    def bytes_a(i):
        return bytes(byte_of[c] for c in name_of[i])

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()

    rows, links = [], []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = [[f(i) for i in own] for f, own in zip((bytes_a, bytes_b), ids)]
        if any(b"".join(r) != whole for r in raw):
            ids, raw = ([], []), ([], [])
        ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
        groups, own, begin = [], [], [0, 0]
        place = [{e: k for k, e in enumerate(side)} for side in ends]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            inside = [ids[s][begin[s] : place[s][cut] + 1] for s in (0, 1)]
            groups.append("|".join(",".join(map(str, g)) for g in inside))
            own.append((inside[0][-1], inside[1][-1]))
            begin = [place[s][cut] + 1 for s in (0, 1)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((len(ids[0]), len(ids[1]), len(groups), len(own), digest))
        links.append(own)
    count = Counter(x for own in links for x in own)
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (*row[:4], sum(count[x] == top[x[1]] for x in own), sum(count[x] for x in own), row[4])
        for row, own in zip(rows, links)
    ]


def odd_texts():
    rng = random.Random(7)
    parts = [" ", "  ", "\n", " \n ", "\t", "a", "the", "Straße", "é", "e\u0301", "ﬁ", "日本", "🙂", "\u00a0", "\u2003", "x" * 30, "1234", "'s", "<|endoftext|>", "<s>", "<unk>", "\x1c", "▁", "\x00", "-", "ab.c"]
    made = ["".join(rng.choice(parts[:-4] if rng.random() < 0.8 else parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    return [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "the the the", "the the the", *made, "long " * 30_000, "y" * 5000]


def test_alignment_against_a_plain_version(spark, monkeypatch):
    with_text = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()][:120]
    texts = odd_texts() + with_text
    rows = [(None if i % 50 == 3 else i // 2, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, pair string").repartition(3)
    got = align.alignments(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    found = Counter(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in got.collect())
    assert found == Counter((row[0], *plain) for row, plain in zip(rows, plain_alignment(texts)))


def test_blocks_and_known_units_do_not_matter(monkeypatch):
    texts = [t for t in odd_texts() if t != "long " * 30_000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    one = align.Aligner(*align.default_files())
    counts, pairs, groups = one.align(batch["text"])
    monkeypatch.setattr(align, "SLICE_BYTES", 100)
    monkeypatch.setattr(align, "KNOWN", 20)
    small = align.Aligner(*align.default_files())
    parts = [small.align(s["text"]) for s in align._slices(iter([batch]))]
    assert len(parts) > 50
    assert pa.concat_arrays([p[1] for p in parts]) == pairs
    assert sum([p[2] for p in parts], []) == groups
    whole = align.Aligner(*align.default_files())
    whole.by_unit = False  # as for a tokenizer that may join across spaces
    assert whole.align(batch["text"])[1:] == (pairs, groups)


def test_a_slice_holds_little_memory():
    """The columns of a slice of many links, as two workers and a JVM share an executor; a process of its own shows the peak."""
    code = """
import pyarrow as pa
from postbud.llm import align
texts = pa.array([f"word {i} of many, and the next one " * 60 for i in range(2500)])
aligner, batch = align.Aligner(*align.default_files()), pa.RecordBatch.from_arrays([texts], ["text"])
print(sum(len(aligner.align(s["text"])[1]) for s in align._slices(iter([batch]))), pa.default_memory_pool().max_memory())
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    links, most = map(int, run.stdout.split())
    assert links > 1_000_000 and most < 64 << 20


def test_alignment_of_no_documents(spark):
    assert align.alignments(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, align.alignments(none).collect())) == [(i, 0, 0, 0, 0, "", 0, 0) for i in (1, 2)]


# ---- hard negatives


def plain_hard_negatives(rows, is_anchor):
    """``rows``: (id, label, whole numbers or None)."""
    taking = [r for r in rows if None not in r]
    out = []
    for a, x in enumerate(taking):
        if not is_anchor(x[0]):
            continue
        scored = sorted((-sum(map(int.__mul__, x[2], y[2])), y[0], y[1], b) for b, y in enumerate(taking) if b != a)
        for s, positive, _, _ in [r for r in scored if r[2] == x[1]][:5]:
            p = -s
            window = [r for r in scored if r[2] != x[1] and 30 * p <= -100 * r[0] <= 90 * p]
            out += [(x[0], positive, rank, r[1], p, -r[0]) for rank, r in enumerate(window[:10], 1)]
    return Counter(out)


def mined(spark, rows, vector="array<double>"):
    df = spark.createDataFrame([(i, label, v, 1, 2) for i, label, v in rows], f"vec_id long, label int, embedding {vector}, score int, block int")
    numbers = hard_negatives.integer_vectors(df.repartition(3))
    got = hard_negatives.mine(numbers, hard_negatives.F.col("id") % 10 == 0)
    return Counter(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def whole(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]


def test_hard_negatives_against_a_plain_version(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 9))
    rows = [(i, int(i % 3), (centres[i % 6] + rng.normal(size=9) * 0.3).tolist()) for i in range(400)]
    rows += [(400 + i, 1, centres[0].tolist()) for i in range(40)]  # copies of one vector, many ties
    rows += [rows[10], rows[10], rows[20]]  # repeated rows, anchors among them
    rows += [(None, 1, [1.0] * 9), (500, None, [1.0] * 9), (510, 1, None), (520, 1, [1.0, None] + [0.0] * 7), (530, 1, [math.nan] * 9), (540, 1, [math.inf] * 9)]
    rows += [(550, 2, [0.0] * 9), (560, -4, [0.5] * 9)]
    assert mined(spark, rows) == plain_hard_negatives([(i, label, whole(v)) for i, label, v in rows], lambda i: i % 10 == 0)


def test_shards_and_blocks_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(3)), np.round(rng.normal(size=6), 1).tolist()) for i in range(300)]
    wanted = plain_hard_negatives([(i, label, whole(v)) for i, label, v in rows], lambda i: i % 10 == 0)
    for shard, block, cell, first in ((300, 300, 2, 1), (40, 7, 8, 4), (1000, 1000, 1000, 10**6)):
        for name, value in zip(("SHARD_ROWS", "BLOCK_ROWS", "CELL_ROWS", "FIRST_ROWS"), (shard, block, cell, first)):
            monkeypatch.setattr(hard_negatives, name, value)
        assert mined(spark, rows) == wanted


def test_scores_beyond_floats_unequal_lengths_and_no_rows(spark):
    big = float(1 << 24)
    rows = [(i, i % 2, [big + i, big - 3 * i, 1.0]) for i in range(40)]
    assert mined(spark, rows) == plain_hard_negatives([(i, label, whole(v)) for i, label, v in rows], lambda i: i % 10 == 0)
    ragged = [(i, i % 2, [float(i % 5)] * (i % 4)) for i in range(60)]
    filled = [(i, label, whole(v + [0.0] * (3 - len(v)))) for i, label, v in ragged]
    assert mined(spark, ragged) == plain_hard_negatives(filled, lambda i: i % 10 == 0)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(10, 1, [1.0]), (11, 2, [1.0])]) == Counter()
    # All scores are cut to the end of a long, so none lies in the window below that.
    assert mined(spark, [(i, i % 2, [1e300] * 2) for i in range(12)]) == Counter()


def test_heap_visits_cells_in_falling_order_and_stops():
    rng = np.random.default_rng(8)
    first, second = np.round(rng.normal(size=7), 1), np.round(rng.normal(size=5), 1)
    heap, seen = hard_negatives.CellHeap(first, second), []
    while heap.heap:
        bound = heap.bound()
        i, j = heap.pop()
        assert bound == pytest.approx(first[i] + second[j])
        seen.append((i, j, bound))
    assert len({s[:2] for s in seen}) == 35 and [s[2] for s in seen] == sorted((s[2] for s in seen), reverse=True)


def test_search_reads_few_cells_where_vectors_lie_in_clusters(monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16)) * 1000
    vectors = np.floor(centres[np.arange(4000) % 20] + rng.normal(size=(4000, 16)))
    table = pa.table({"row": np.arange(4000), "id": np.arange(4000), "label": np.arange(4000) % 3, "vector": vectors.tolist()})
    books = hard_negatives.k_means(vectors[:, :8], 20), hard_negatives.k_means(vectors[:, 8:], 20)
    shard = hard_negatives.Shard(table, books)
    anchors = table.slice(0, 50).append_column("windows", pa.array([[{"bound": 0, "low": hard_negatives.LEAST, "high": hard_negatives.MOST}]] * 50))
    read = []
    score = shard.scores_with(vectors[:50])
    monkeypatch.setattr(shard, "scores_with", lambda _: lambda of, a, b: read.append(len(of) * (b - a)) or score(of, a, b))
    found = hard_negatives.search(shard, anchors, True, 5)
    assert sum(read) < 0.25 * 50 * 4000
    for a, best in enumerate(found):
        exact = sorted((-int(vectors[a] @ vectors[i]), i) for i in range(4000) if i != a and i % 3 == a % 3)[:5]
        assert [(-s, i) for s, i in zip(best.score.tolist(), best.id.tolist())] == exact


# ---- URL rules


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def plain_verdict(host, path, rules, default="allow"):
    fits = []
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        if (host == own or host.endswith("." + own) or not own) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, default)


URLS = [
    None, "", "no scheme.net/", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "ftp://a.b.example.net/en/1?q#f", "x://example.net/en",
    "https://www.example.com/de/1", "https://example.com/de", "https://notexample.com/de/1", "https://example.com.evil/de/", "http://fr.org/fr/",
    "http://org/fr/x", "http://orgs/fr/x", "http://example.net?x=/en/", "http://example.net#://b.org/fr/", "://org/fr/", "a://b://org/fr/", "http://É.NET/",
    "http://u@a.net:80/", "http://a.net:80/", "http://a.net/\n/x", "http://a\n.net/", "http://[::1]/", "http://x.example.org/a.b/c", "http://" + "a." * 50_000 + "net/" + "p/" * 50_000,
]
OWN = [*url_filter.RULES, ("block", "example.org"), ("allow", "x.example.org/a.b"), ("block", "/secret/"), ("block", "a.net/"), ("allow", "a.net/"), ("block", "EXAMPLE.org/A/")]


@pytest.mark.parametrize("rules", [url_filter.RULES, OWN, ()])
def test_url_rules_against_a_plain_version(spark, rules):
    urls = URLS + [f"http://{h}/{p}" for h in ("example.org", "x.example.org", "EXAMPLE.ORG", "aexample.org") for p in ("", "a.b", "a.bc", "axb", "A/1", "secret/1")]
    rows = [(None if i % 9 == 8 else i // 2, u, "r", "v", 1) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host string, `row` int").repartition(2)
    got = url_filter.judge(pages, url_filter.rule_table(spark, rules))
    lowered = [(v, r) for v, r in rules]
    wanted = Counter()
    for row in rows:
        host, path = plain_parts(row[1])
        fitted = [(v, r.split("/")[0].lower() + r[len(r.split("/")[0]):]) for v, r in lowered]
        rule, verdict = plain_verdict(host, path, fitted)
        names = {lo: r for (_, lo), (_, r) in zip(fitted, lowered)}
        wanted[(row[0], host, path, names.get(rule), verdict)] += 1
    assert Counter(tuple(r) for r in got.collect()) == wanted


def test_url_rules_with_wildcards_and_odd_characters(spark):
    rules = [("block", "cdn*.example.net/"), ("allow", "example.net/img/*/free"), ("block", "a+b.net/(x)/"), ("block", "net/a.*c/")]
    pages = spark.createDataFrame(
        [(1, "http://cdn7.example.net/x"), (2, "http://example.net/img/a/b/freely"), (3, "http://a+b.net/(x)/y"), (4, "http://aab.net/x/"), (5, "http://z.net/a.bbc/"), (6, "http://z.net/axc/")],
        "page_id long, url string",
    )
    got = {r["page_id"]: r["rule"] for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()}
    assert got == {1: rules[0][1], 2: rules[1][1], 3: rules[2][1], 4: None, 5: rules[3][1], 6: None}


def test_rules_are_filed_under_their_rarest_token_and_nothing_is_tried_on_all(spark):
    seen = spark.createDataFrame([(i, t) for i, t in enumerate(["net"] * 5 + ["example"] * 2 + ["en"] * 3 + ["other"])], "row long, token string")
    index = {r["rule"]: r["token"] for r in url_filter.rarest_token_index(seen, url_filter.rule_table(spark)).collect()}
    assert index == {"net/": "net", "example.net/en/": "example", "example.com/de/": "com", "org/fr/": "fr"}
    plan = url_filter.judge(spark.read.parquet(f"{SF_DIR}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]


def test_url_rules_without_pages(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
