"""Every operator against a plain version on small tables: nulls, empty and long texts, ties, repeats, odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from postbud.llm import (
    decontaminate,
    fingerprints,
    html,
    language,
    line_dedup,
    mixing,
    near_dup,
    queries,
    suffix_dedup,
    tokens,
    warc,
)
from tests.compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `node` int, `text_a` string"


def words(seed, n, alphabet="abcdefghijk"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = words(1, 300)
    near = base.split()
    near[150] = "changed"
    return [
        base, base, " ".join(near), words(2, 300), None, "", " \n\t", "one two", "One  two", "x" * 5000,
        words(3, 4000), base + "\n" + words(4, 60), "\n".join([words(5, 12)] * 7),
        *[words(6, 12) + "\n" + words(10 + i, 30) for i in range(7)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Extra columns have names that operators use themselves; some rows repeat, one has no doc_id."""
    rows = [(i, t, None if i % 7 == 0 else "xx", f"s{i % 3}" if i % 5 else None, 1, i, "b") for i, t in enumerate(texts)]
    rows += [rows[0], rows[3], (None, texts[2], "xx", "s1", 1, 0, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


# ---- near duplicates


def shingle_set(text):
    w = re.findall(r"[^ \t\n\v\f\r]+", text.lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def test_near_duplicates(docs):
    classes = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs).collect()}
    rows = plain(docs)
    assert len(near_dup.near_duplicates(docs).collect()) == len(rows)
    for a, x in rows:
        for b, y in rows:
            if a is None or b is None:
                continue
            p, q = shingle_set(x), shingle_set(y)
            alike = x == y if not p or not q else (p & q).total() >= 0.9 * (p | q).total()
            unlike = (p & q).total() < 0.5 * (p | q).total() if p and q else x != y
            if alike:
                assert classes[a] == classes[b]
            if unlike:
                assert classes[a] != classes[b]


def test_pivots_reach_every_link_of_a_large_group(spark):
    """Copies alike to one original, not to each other, and a chain."""
    base = words(50, 200).split()
    rng, rows = random.Random(1), []
    for i in range(60):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"w{rng.random()}"
        rows.append((100 + i, " ".join(copy)))
    rows.append((999, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in near_dup.near_duplicates(df).collect()} == {100}


def test_pairs_of_one_leading_node_are_dealt_in_parts(spark, monkeypatch):
    """A node that leads many pairs, beside nodes of one pair: every pair is verified once, as by counting."""
    monkeypatch.setattr(near_dup, "MEMBERS", 8)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 4000)
    base, rng = words(70, 60).split(), random.Random(2)
    texts = {i: " ".join(base[: rng.randint(20, 60)] + words(100 + i, 5).split()) for i in range(80)}
    pairs = [(0, i) for i in range(1, 70)] + [(70 + i, 71 + i) for i in range(9)]
    found = near_dup._likenesses(
        spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(list(texts.items()), "node long, text string"), 300,
        spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0, np.float32))),
    ).collect()
    assert sorted((r["a"], r["b"]) for r in found) == sorted(pairs)
    for r in found:
        x, y = shingle_set(texts[r["a"]]), shingle_set(texts[r["b"]])
        assert r["likeness"] == pytest.approx((x & y).total() / (x | y).total(), abs=1e-6)


def test_links_by_likeness_of_pairs(spark):
    """Pairs of every plain likeness from 0.5 on: all from 0.8 on are one class, none below."""
    rows, want = [], {}
    for i in range(150):
        one = words(5000 + i, 400).split()
        two = list(one)
        for place in random.Random(i).sample(range(400), i % 30):
            two[place] = f"changed{place}"
        x, y = " ".join(one), " ".join(two)
        p, q = shingle_set(x), shingle_set(y)
        want[2 * i] = (p & q).total() / (p | q).total()
        rows += [(2 * i, x), (2 * i + 1, y)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    classes = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    assert sum(0.8 <= v < 0.9 for v in want.values()) >= 20 and sum(0.7 <= v < 0.8 for v in want.values()) >= 20
    assert [i for i, v in want.items() if (classes[i] == classes[i + 1]) != (v >= 0.8)] == []


def test_rows_by_bucket_hold_numbers_only(spark, monkeypatch):
    """Sketches join the members of open buckets, not all rows of all bands; copies and repeated rows are members once."""
    staged, stage = {}, near_dup.stage
    monkeypatch.setattr(near_dup, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    base, other = words(31, 80), words(32, 80)
    near = [" ".join([f"x{i}", *base.split()[1:]]) for i in range(4)]
    rows = [(i, t) for i, t in enumerate([base, base, *near, other, ""])] + [(0, base), (6, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 6, 7: 7}
    assert sorted(staged["buckets"].columns) == ["bucket", "first", "n", "node"]
    assert staged["sketches"].count() == 6
    members = staged["buckets"].groupBy("bucket").agg({"node": "count", "n": "max"}).collect()
    assert members and all(r["count(node)"] == r["max(n)"] > 1 for r in members)


def test_common_shingles_are_counted_exactly(docs):
    key, idf, n = near_dup.common_shingles(docs, rare=0.2)
    rows = plain(docs)
    df = Counter(s for _, t in rows for s in shingle_set(t))
    assert n == len(rows) and len(key) == sum(c > 0.2 * n for c in df.values())
    assert sorted(idf) == pytest.approx(sorted(0.5 + 0.5 * np.log(n / c) / np.log(5) for c in df.values() if c > 0.2 * n))


def test_common_shingles_are_held_whatever_the_length_of_texts(spark):
    """Many more distinct shingles a document than a small summary holds, in many partitions."""
    shared = [words(900 + i, 9) for i in range(8)]
    rows = [(i, words(1000 + i, 300) + " " + shared[i % 8] + " " + words(2000 + i, 300)) for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    want = Counter(s for _, t in rows for s in shingle_set(t))
    key, idf, n = near_dup.common_shingles(df, rare=0.1, size=64)
    assert n == 64 and len(key) == sum(c > 6.4 for c in want.values()) >= 40


def test_idf_of_a_group_of_a_third(spark):
    """The README's figure: shingles of a third of all rows weigh 0.62, so copies there link from a plain likeness of 0.87 on."""
    idf = 0.5 + 0.5 * np.log(3) / np.log(1 / near_dup.RARE)
    plain = lambda t: t / (t + idf * (1 - t))
    assert idf == pytest.approx(0.62, abs=0.005) and plain(near_dup.THRESHOLD) == pytest.approx(0.866, abs=0.001)


def test_samples_agree_as_often_as_texts_are_alike():
    key = np.sort(np.random.default_rng(1).integers(1, 1 << 54, 400, dtype=np.uint64))
    weight = np.random.default_rng(2).choice([0.5, 1.0, 2.0], 400).astype(np.float32)
    one = near_dup.samples(np.zeros(300, int), key[:300], weight[:300], 1, 1000)
    two = near_dup.samples(np.zeros(300, int), key[100:], weight[100:], 1, 1000)
    assert (one == two).mean() == pytest.approx(weight[100:300].sum() / weight.sum(), abs=0.05)


def test_keep_one(spark, docs):
    kept = near_dup.keep_one(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(0) == 1 and 1 not in ids and 2 not in ids and {3, 9, 10} <= set(ids)


def test_a_large_class_is_not_held_against_itself(spark):
    """A stray member of a bucket of 20,000 is held against all, and each of them against the stray only."""
    F = mixing.F
    top = F.struct(F.lit(19_999).cast("long").alias("size"), F.lit(0).cast("long").alias("class"))
    members = spark.range(20_000).select(
        F.col("id").alias("node"), F.when(F.col("id") == 77, 77).otherwise(0).cast("long").alias("class"),
        F.lit(20_000).cast("long").alias("n"), top.alias("top"),
    )
    rows = near_dup.deal(members).select("node", "part", F.explode("others").alias("other"))
    assert rows.count() == 19_999 + 1 + -(-19_999 // near_dup.MEMBERS)
    blocks = lambda n: {(min(r["part"], r["other"]), max(r["part"], r["other"])) for r in rows.where(F.col("node") == n).collect()}
    assert all(blocks(n) <= blocks(77) and len(blocks(n)) == 1 for n in (0, 76, 78, 19_999))


def test_rows_that_share_or_lack_a_doc_id(spark):
    """No text is lost whose likes are nowhere else, and of every class one row stays."""
    a, b, c, d, e = (words(40 + i, 120) for i in range(5))
    near = " ".join(["changed", *d.split()[1:]])
    rows = [(5, a), (5, b), (3, b), (5, e), (7, c), (None, c), (None, d), (None, d), (None, near), (8, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert shingle_set(d) and (shingle_set(d) & shingle_set(near)).total() >= 0.9 * (shingle_set(d) | shingle_set(near)).total()
    kept = [(r["doc_id"], r["text"]) for r in near_dup.keep_one(spark, df, "").collect()]
    fixed = {(5, a), (3, b), (5, e), (7, c), (8, None)}
    assert len(kept) == 6 and fixed < set(kept) and (set(kept) - fixed).pop() in {(None, d), (None, near)}
    found = near_dup.near_duplicates(df).collect()
    assert len(found) == len(rows) and len({r["class_id"] for r in found}) == 6
    assert sorted(r["class_id"] for r in found if r["doc_id"] in (3, 7)) == [3, 7]


# ---- fingerprints


def test_fingerprints(docs):
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs.dropDuplicates(["doc_id"])).collect()}
    rows = sorted(dict(plain(docs)).items(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (i, text), (j, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        row = found[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert (row["fingerprint"][:64] == found[0]["fingerprint"][:64]) == (text == (plain(docs.where("doc_id = 0"))[0][1]))
        assert 0 <= row["near_edited"] <= 1 and (row["near_edited"] == 1) == (edit == text)
        assert (row["near_next"] == 1) == (text == after)
    assert found[0]["fingerprint"] == found[1]["fingerprint"]
    assert 0.2 < found[10]["near_edited"] < 0.8


def test_fingerprints_locate_an_edit(spark):
    text = "\n".join(words(60 + i, 30) for i in range(20))
    other = text.replace(words(65, 30), "something else entirely")
    df = spark.createDataFrame([(1, text), (2, other)], "i int, t string")
    one, two = (r[0].split("|")[1:] for r in df.orderBy("i").select(fingerprints.fingerprint(df["t"])).collect())
    differ = set(one) ^ set(two)
    assert 0 < len(differ) <= 4 and len(set(one) & set(two)) >= len(one) - 2


# ---- suffixes


def removed(rows):
    data = [t.encode() for _, t in rows]
    n = suffix_dedup.LENGTH
    seen = Counter(d[p : p + n] for d in data for p in range(len(d) - n + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 2, bool)
        for p in range(len(d) - n + 1):
            if seen[d[p : p + n]] > 1:
                gone[p + 1 : p + n + 1] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[1:-1]])
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_suffix_dedup(spark, docs):
    assert Counter(map(tuple, suffix_dedup.suffix_dedup_digests(docs).collect())) == removed(plain(docs))
    base = words(70, 400, "abé")
    rows = [(i, base[i * 7 : i * 7 + 190 + i] + str(i)) for i in range(40)] + [(90, "a" * 900), (91, "ab" * 300), (92, "z" * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, suffix_dedup.suffix_dedup_digests(df).collect())) == removed(rows)


def test_suffixes_that_lead_alike_are_merged_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE", 8)
    passage = words(71, 100)[:260]
    rows = [(i, f"{words(72 + i, 30)} {passage} {words(400 + i % 25, 12)}") for i in range(60)]
    # Pairs that share a passage with all, and what follows with each other only: both may be in different shares.
    rows += [(300 + i, f"{words(1000 + i, 9)} {passage[:190]}{words(2000 + i % 40, 30)[:60]}") for i in range(80)]
    rows += [(100 + i, f"{words(72 + i, 30)[-40 - i :]} {passage}{i}") for i in range(20)] + [(200, passage[:199]), (201, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = []
    run_rows = suffix_dedup._cuts
    monkeypatch.setattr(suffix_dedup, "_cuts", lambda kept: parts.append(run_rows(kept)) or parts[-1])
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        found = Counter(map(tuple, suffix_dedup.suffix_dedup_digests(df).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts[0][1].max() > 1
    assert found == removed([(i, t or "") for i, t in rows])


def test_merge_gives_order_and_shared_prefixes():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    runs = []
    for i in range(7):
        own = sorted(strings[i::7])
        rows = np.frombuffer(b"".join(own), np.uint8).reshape(-1, 12)
        runs.append((own, suffix_dedup._shared(rows).tolist()))
    order, shared = suffix_dedup.merge(runs)
    place, merged = [0] * 7, []
    for r in order:
        merged.append(runs[r][0][place[r]])
        place[r] += 1
    assert merged == sorted(strings)
    assert shared[1:] == [next((k for k in range(12) if a[k] != b[k]), 12) for a, b in zip(merged, merged[1:])]


# ---- lines


def kept_lines(rows, least=5, last_of_texts=None):
    """``last_of_texts``: the text that stands last among those without doc_id."""
    holder = lambda i, t: (i is not None, i or 0, "" if i is not None else t if t != last_of_texts else "\U0010ffff")
    key = lambda line: line.strip(" \t\n\v\f\r").encode().lower()
    holders = {}
    for i, t in rows:
        for line in t.split("\n"):
            if len(line.strip(" \t\n\v\f\r")) >= 40:
                holders.setdefault(key(line), set()).add(holder(i, t))
    out = []
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), ())) < least or max(h) == holder(i, t) or len(x.strip(" \t\n\v\f\r")) < 40]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(docs):
    assert Counter(map(tuple, line_dedup.line_dedup_digests(docs).collect())) == kept_lines(plain(docs))


def test_a_frequent_line_over_many_partitions(spark):
    line = words(80, 20)
    rows = [(i, f"{line}\nown {i}\n {line.upper()}\t") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        found = Counter(map(tuple, line_dedup.line_dedup_digests(df).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == kept_lines(rows)


def test_texts_without_doc_id_are_documents_of_their_own(spark):
    line, other = words(81, 20), words(82, 20)
    rows = [(None, f"{line}\nown {i}\n{other if i % 2 else ''}") for i in range(60)] + [(None, f"{line}\nown 3\n{other}")]
    rows += [(i, f"{line} \n{i}") for i in range(3)] + [(7, words(83, 20)), (None, words(83, 20))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = df.select("text", line_dedup.F.xxhash64("text").alias("h")).where(line_dedup.F.contains("text", line_dedup.F.lit(other)))
    last = max(hashed.collect(), key=lambda r: r["h"])["text"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = Counter(map(tuple, line_dedup.line_dedup_digests(df.repartition(5)).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == kept_lines(rows, last_of_texts=last)


def test_drop_repeated_lines(spark, docs):
    out = line_dedup.drop_repeated_lines(spark, docs, "")
    assert out.schema == docs.schema or out.columns == docs.columns
    assert out.count() == docs.count()
    assert out.where("doc_id = 19").head()["text"] == docs.where("doc_id = 19").head()["text"]
    assert "\n" not in out.where("doc_id = 13").head()["text"]


# ---- mixing


def test_targets_share_everything(spark):
    rows = [(i, "w " * (1000 if i % 3 else 1), f"s{i % 5}") for i in range(200)] + [(900, "w " * 10, None), (901, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixture(df).collect()
    sizes = df.select("source", mixing.size_of(df["text"]).alias("size"))
    targets = [(r["source_size"], r["target"]) for r in mixing.targets(sizes).collect()]
    assert sum(t for _, t in targets) == pytest.approx(sum(r["size"] for r in found))
    assert all(t <= 3 * s + 1e-6 for s, t in targets) and all(r["taken"] <= 3 * r["size"] for r in found)


def test_rows_without_doc_id_draw_apart(spark):
    rows = [(None, "w " * 100, "a") for _ in range(600)] + [(None, "v " * (50 + i % 9), "a") for i in range(300)]
    rows += [(i, "w " * 40, "b") for i in range(1500)] + [(None, None, None), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixture(df.repartition(7)).collect()
    assert len(found) == len(rows)
    targets = {r["source_size"]: r["target"] for r in found}
    for size, target in targets.items():
        assert sum(r["taken"] for r in found if r["source_size"] == size) == pytest.approx(target, rel=0.1)
    as_rows = lambda rows: Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)
    assert as_rows(found) == as_rows(mixing.mixture(df.repartition(2)).collect())
    taken = sum(len((r["text"] or "").split()) for r in mixing.mix(spark, df.repartition(3), "").collect())
    assert taken == sum(r["taken"] for r in found)


def test_mix_repeats_documents(spark, docs):
    out = mixing.mix(spark, docs, "")
    assert out.columns == docs.columns and out.count() > 0
    taken = sum(len((r["text"] or "").split()) for r in out.collect())
    assert taken == sum(r["taken"] for r in mixing.mixture(docs).collect())


# ---- pages


def test_extract():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><nav>menu</nav><div class=ad>buy</div>"
        "<div id=layout><div class=story><h2>Head &amp; line</h2><p>First  para\n with <a href=x>a link</a> and words enough to weigh."
        "<p>Second para, of some length too.<ul><li>one<li>two</ul></div>"
        "<section class='user-comments'><p>A reader comment that is long, longer than the rest of the page by itself, really.</p></section>"
        "</div><form>f<input></form><footer>foot</footer><script>x='</p>'</script></body></html>"
    )
    assert html.extract(page) == (
        "Head & line\nFirst para with a link and words enough to weigh.\nSecond para, of some length too.\none\ntwo"
    )
    assert html.extract("") == "" and html.extract("a &lt; b") == "a < b"
    assert html.extract("<article><p>a<p>b</article>") == "a\nb"
    assert html.extract("<div>" * 3000 + "deep") == "deep"


def test_extract_keeps_text_parted_by_line_breaks():
    """Bare strings beside the path to the core are judged like elements; bare links and short marks are not content."""
    lines = [f"Line {i} " + words(700 + i, 30) for i in range(6)]
    points = [f"{i} " + "point " * 9 + "end" for i in range(10)]
    bullets = "<ul>" + "".join(f"<li>{p}</li>" for p in points) + "</ul>"
    links = "".join(f"<a href=x>link {i}</a> " for i in range(12))
    page = f"<html><body>{links}<div>{'<br>'.join(lines[:3])}{bullets}{lines[3]}<br> <b>{lines[4]}</b><br>{lines[5]}</div></body></html>"
    assert html.extract(page) == "\n".join([" ".join(lines[:3]), *points, " ".join(lines[3:])])
    beside = f"<body><div><a href=x>q</a> <a href=x>r</a></div>{lines[0]}<br>{lines[1]}<div>{bullets}</div></body>"
    assert html.extract(beside) == "\n".join([" ".join(lines[:2]), *points])


def test_extract_keeps_pages_whose_layout_bears_a_noise_word():
    parts = [words(720 + i, 40) for i in range(4)]
    paragraphs = "".join(f"<p>{p}</p>" for p in parts)
    beside = "<div class='social-widget'>Follow us here</div><div class=sidebar><a href=x>more</a></div>"
    for layout in ("<div class='elementor-widget-container'>{}</div>", "<section id='related-work'><h2>Related</h2>{}</section>"):
        text = html.extract(f"<html><body>{layout.format(paragraphs)}{beside}</body></html>")
        assert text.split("\n")[-4:] == parts and "Follow" not in text and "more" not in text
    each = "".join(f"<div class='elementor-widget'><p>{p}</p></div>" for p in parts)
    assert html.extract(f"<body><div>{each}</div>{beside}</body>") == "\n".join(parts)
    assert html.extract(f"<body><div class=ad>{parts[0]}</div><article>short text</article></body>") == "short text"
    assert html.extract(f"<body><div>{paragraphs}</div><div class=comments><p>{words(730, 40)}</p></div></body>") == "\n".join(parts)


def test_main_text_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>t</p>", "y"), (1, "u", None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html.main_text(df).collect()), key=str) == sorted([(1, "u", "", 0)] * 2 + [(None, None, "t", 1)], key=str)


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://d", ""), (2, "http://b", "same"), (None, "x y", "é" * 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", mixing.F.lit(1))
    found = Counter(map(tuple, warc.round_trip(df.repartition(3)).collect()))
    want = Counter()
    for i, _, payload in rows:
        data = (payload or "").encode()
        top = max(j or 0 for j, _, p in rows if (p or "") == (payload or ""))
        revisit = (i or 0) != top
        want[(i, len(data), warc.payload_digest(data), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert found == want


def test_warc_small_payloads_are_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    index = warc.write_archives(df, str(tmp_path / "w"), min_bytes=3)
    assert {r["record_type"] for r in warc.read_archives(index, str(tmp_path / "w")).collect()} == {"response"}
    row = index.where("page_id = 2").head()
    data = (tmp_path / "w" / row["file"]).read_bytes()[row["offset"] : row["offset"] + row["length"]]
    fields, http, payload = warc.parse(zlib.decompress(data, 31))
    assert payload == b"ab" and http["Content-Length"] == "2" and fields["WARC-Target-URI"] == "u"


def test_ranges_are_joined():
    assert warc.ranges([(0, 10), (10, 5), (100, 5), (1000, 5)], gap=90, most=200) == [(0, 105, 3), (1000, 1005, 1)]
    assert warc.ranges([(0, 150), (150, 100)], gap=0, most=200) == [(0, 150, 1), (150, 250, 1)]


# ---- tokens


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_vocabulary())
    rng = random.Random(8)
    odd = ["aaaa aaa  aa<|endoftext|>b\n\n\n  c", "  x 日本語 😀 it's don'T 12345", "".join(rng.choice("abc .,\nd é😀'st \t") for _ in range(4000)), "q" * 9000]
    rows = plain(docs) + [(500 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter()
    for i, t in rows:
        n = len(library.encode(t, add_special_tokens=False).ids)
        want[(i, len(t.encode()), n, n > 1024)] += 1
    assert Counter(map(tuple, tokens.token_counts(df).collect())) == want


# ---- benchmark


def test_contaminated(spark):
    items = [(i, words(200 + i, 30) + ". " + words(300 + i, 5) + ".") for i in range(12)] + [(50, None), (51, ""), (52, words(400, 4)), (52, words(400, 4))]
    rows = [(i, words(500 + i, 300)) for i in range(60)]
    paraphrase = items[3][1].split()
    paraphrase[2] = paraphrase[9] = paraphrase[15] = "other"
    rows += [(100, rows[0][1] + " " + items[1][1].upper() + " " + rows[1][1]), (101, rows[2][1] + " " + " ".join(paraphrase)), (102, words(600, 50) + " " + items[-1][1]), (103, None), (None, items[2][1]), (100, rows[0][1] + " " + items[1][1].upper() + " " + rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert found == {(100, 1), (101, 3), (102, 52), (None, 2)}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def brute_force(rows, items):
    """Pairs of document and item that any passage's region makes a hit."""
    step, found = decontaminate.STEP, set()
    own = {i: decontaminate._hashes(t) for i, t in items}
    answers = {i: decontaminate._answer(t) for i, t in items}
    for d, text in rows:
        h = decontaminate._hashes(text)
        held = set(h.tolist())
        for i, w in own.items():
            if sum(x in held for x in w.tolist()) < decontaminate.PARAPHRASE * len(w):
                continue
            regions = (h[max(at - len(w), 0) : at + 2 * step + len(w)] for at in range(0, len(h), step))
            if any(decontaminate.verify(w, answers[i], r) for r in regions):
                found.add((d, i))
    return found


def test_contaminated_finds_all_that_brute_force_finds(spark):
    """Items of 1 to 60 words of a skewed vocabulary, verbatim, with a third changed, and chance likeness, by length."""
    rng = random.Random(11)
    vocabulary = [f"w{i}x" for i in range(3000)]
    draw = lambda n: rng.choices(vocabulary, [1 / (r + 3) for r in range(3000)], k=n)
    items, rows = [], []
    for i in range(700):
        n = [rng.randint(1, 4), rng.randint(5, 7), rng.randint(8, 11), rng.randint(12, 20), rng.randint(21, 60)][i % 5]
        item = draw(n)
        if n >= 8:
            item[n - 5] += "."
        items.append((i, " ".join(item)))
        copy = list(item)
        if i % 2 and n >= 8:
            for at in rng.sample(range(n - 4), (n - 4) // 3):
                copy[at] = rng.choice(vocabulary)
        if i % 3 == 0:
            copy = draw(rng.randint(0, 90)) + copy + draw(rng.randint(0, 90))
            rows.append((1000 + i, " ".join(copy)))
    want = brute_force(rows, items)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()}
    sizes = {i: len(t.split()) for i, t in items}
    recall = {}
    for low, high in ((1, 4), (5, 7), (8, 11), (12, 20), (21, 60)):
        there = {p for p in want if low <= sizes[p[1]] <= high}
        recall[low, high] = (len(there & found), len(there))
    print(recall)
    assert found == want, recall
    assert all(n >= 30 for _, n in recall.values())


def test_subsequence():
    rng = random.Random(3)
    for _ in range(30):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.subsequence(np.array(a), np.array(b)) == best[-1][-1]


# ---- language


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = language.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_language_of_odd_rows(spark, docs, no_docs):
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert found[4]["lang_pred"] == found[5]["lang_pred"] == found[6]["lang_pred"] == "und" and found[4]["score"] == 0
    assert found[10]["lang_pred"] == "xx" and 0 <= found[10]["score"] <= 1
    unlabelled = docs.withColumn("lang", mixing.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.keep_accepted(spark, docs, "").schema == docs.schema


def plain_models(texts):
    """Interpolated Kneser-Ney by dictionaries: P(symbol | three before) of a language, as a function."""
    grams = {x: [Counter(g for t in own for g in plain_grams(t))] for x, own in texts.items()}
    for orders in grams.values():
        for _ in range(3):
            orders.append(Counter(g[1:] for g in orders[-1]))
    n_symbols = len({g for orders in grams.values() for g in orders[-1]}) + 1

    def learn(orders):
        discounts, totals, kinds = [], [], []
        for counts in orders:
            once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
            discounts.append(once / (once + 2 * twice) if once and twice else 0.5)
            totals.append(Counter())
            for g, c in counts.items():
                totals[-1][g[:-1]] += c
            kinds.append(Counter(g[:-1] for g in counts))

        def probability(g, k=0):
            if k == 4:
                return 1 / n_symbols
            below = probability(g[1:], k + 1)
            total = totals[k][g[:-1]]
            if not total:
                return below
            seen = max(orders[k][g] - discounts[k], 0) / total
            return seen + discounts[k] * kinds[k][g[:-1]] / total * below

        return probability

    return {x: learn(orders) for x, orders in grams.items()}


def plain_grams(text):
    line = re.sub(r"[\W\d_]+", " ", text.lower()).lstrip(" ")
    return ["   "[: max(3 - i, 0)] + line[max(i - 3, 0) : i + 1] for i in range(len(line))]


def test_languages_are_those_of_plain_models(spark):
    alphabets = {"p": "abcdeé", "q": "cdefgh", "r": "ghijkà", "s": "abghxy"}
    rows = [
        (i, words(7000 + i, 3 + i % 40, alphabets[x]) + f" {i}?", x if i % 11 else None)
        for i, x in enumerate(sorted(alphabets) * 60)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    crc = lambda text: zlib.crc32(text.encode())
    learnt = {x: [t for i, t, y in rows if x == y and crc(str(i)) % 4 != 2 and crc(f"hold:{i}") % 5] for x in alphabets}
    models = plain_models(learnt)
    found = {r["doc_id"]: r for r in language.identify(df).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        grams = plain_grams(text)
        entropy = {x: -sum(np.log2(p(g)) for g in grams) / len(grams) for x, p in models.items()}
        assert found[i]["lang_pred"] == min(entropy, key=entropy.get)
        assert found[i]["cross_entropy"] == pytest.approx(min(entropy.values()))
        spread = [-(e - found[i]["cross_entropy"]) * min(len(grams), language.EVIDENCE) for e in entropy.values()]
        assert found[i]["score"] == pytest.approx(1 / sum(2**v for v in spread))


def test_models_hold_only_what_a_language_has():
    """Entries grow with the n-grams seen, not with n-grams times languages."""
    rng, counts = np.random.default_rng(5), {}
    for i in range(40):
        gram = np.unique(rng.integers(97 + 5 * i, 102 + 5 * i, (300, 4)) @ (1 << 16) ** np.arange(4)).astype(np.uint64)
        counts[f"x{i}"] = gram, np.ones(len(gram), int)
    models = language.Models(counts)
    assert len(models.gram[4].value) == sum(len(g) for g, _ in counts.values())
    assert len(models.gram[1].value) == 40 * 5 and len(models.context[1].value) == 40


def test_models_are_distributions():
    gram = np.unique(np.random.default_rng(4).integers(97, 101, (500, 4)) @ (1 << 16) ** np.arange(4)[::-1]).astype(np.uint64)
    models = language.Models({"a": (gram, np.arange(1, len(gram) + 1))})
    context = gram[:20] & ~np.uint64(0xFFFF)
    total = sum(np.exp2(models.log_probability(context | np.uint64(c))[:, 0]) for c in range(97, 101))
    assert np.all(total <= 1 + 1e-9) and np.all(total > 0.8)


# ---- all


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op7", "op10"])
def test_empty_tables(no_docs, name):
    operator = {
        "op1": near_dup.near_duplicates, "op2": fingerprints.fingerprints, "op3": suffix_dedup.suffix_dedup_digests,
        "op4": line_dedup.line_dedup_digests, "op5": mixing.mixture, "op7": tokens.token_counts, "op10": language.identify,
    }[name]
    assert operator(no_docs).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_has_the_rows_of_its_sql(spark, name):
    rows = spark_rows(queries.queries()[name](spark, SF_DIR))
    assert difference(rows, duck_rows(connect(SF_DIR), queries.oracle_sql()[name])) is None


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert out.columns == docs.columns and 0 < out.select("doc_id").distinct().count() < docs.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_and_odd_tables(spark, docs, no_docs, stage):
    _, apply = corpus_pipeline.STAGES[stage]
    for table in (no_docs, docs):
        out = apply(spark, table, SF_DIR)
        assert out.columns == docs.columns and out.count() <= 3 * table.count()
