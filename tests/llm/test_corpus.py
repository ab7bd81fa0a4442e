"""Corpus-wide operators against brute force, on rows with nulls, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parity import connect, differences
from prefspark.llm import decontamination, near_duplicates, quality_classifier, quality_rules, warc
from prefspark.llm.common import without
from prefspark.llm.oracles import ORACLES
from prefspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, row_id string, label string, positions string"
WORDS = [chr(97 + i // 20) + chr(97 + i % 20) + "x" for i in range(400)]


def frame(spark, rows):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns whose names operators use."""
    return spark.createDataFrame([(*r[:2], r[2] if len(r) > 2 else "s", None, 1, "x", "y", "z") for r in rows], SCHEMA)


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


# Decontamination


def lowered_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(docs, items):
    phrases = defaultdict(set)
    for item_id, text in items:
        words = lowered_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            phrases[tuple(words[i : i + n])].add(item_id)
    found = []
    for doc_id, text in docs:
        words, hit, seen = lowered_words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(words) - n + 1):
                if (p := tuple(words[i : i + n])) in phrases:
                    hit |= set(range(i, i + n))
                    seen |= {str(x) for x in phrases[p] if x is not None}
        sha = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(seen), sha, bool(hit)))
    return sorted(found, key=str)


def test_contamination(spark):
    rnd = random.Random(2)
    items = [(i, sentence(rnd, rnd.choice([1, 2, 3, 9, 10, 11, 40]))) for i in range(12)]
    items += [(12, None), (13, "  .. "), (3, items[3][1]), (None, items[5][1] + " tail"), (14, "Ünï Çödé x9"), (15, "same same same"), (16, "aax")]
    docs = []
    texts = [t or "" for _, t in items]
    for i in range(60):
        docs.append((i, f"{sentence(rnd, 30)} {rnd.choice(texts).upper()}; {sentence(rnd, 5)}"))
    docs += [(None, texts[6]), (None, texts[6]), (7, texts[11]), (61, ""), (62, None), (63, "same same same same same"), (64, "aax " * 20000)]
    schema = "item_id long, text string, term string, key string"
    table = spark.createDataFrame([(*r, "a", "b") for r in items], schema)
    got = decontamination.contamination(frame(spark, docs), table).collect()
    assert sorted(map(tuple, got), key=str) == plain_contamination(docs, items)
    assert decontamination.contamination(frame(spark, []), table).count() == 0
    clean = decontamination.contamination(frame(spark, docs), spark.createDataFrame([], schema))
    assert clean.where("contaminated or n_items > 0").isEmpty() and clean.count() == len(docs)


def test_full_index_gives_the_same(spark, monkeypatch):
    docs = frame(spark, [(1, "a b c d"), (2, "b a"), (3, None)])
    items = spark.createDataFrame([(1, "b c"), (2, "x")], "item_id long, text string")
    pruned = sorted(decontamination.contamination(docs, items).collect())
    monkeypatch.setattr(decontamination, "VOCABULARY_LIMIT", 1)
    assert sorted(decontamination.contamination(docs, items).collect()) == pruned


def test_proximity(spark):
    docs = frame(spark, [(1, "red green x blue"), (2, "green red blue"), (3, "red x x x green blue")])
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    near = decontamination.contamination(docs, items, slop=2).where("contaminated").select("doc_id").collect()
    assert sorted(r.doc_id for r in near) == [1, 2]
    assert decontamination.contamination(docs, items).where("contaminated").isEmpty()


# Near duplicates


def plain_components(docs, size, pct):
    sets = []
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        whole = {tuple(words)} if words else set()
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or whole)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for j, both in Counter(j for x in own for j in holders[x]).items():
            if 100 * both >= pct * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for x in own:
            holders[x].append(i)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    named = [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))]
    return sorted([(*r, r[0] == r[2]) for r in named], key=str)


def edited(rnd, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rnd.randrange(len(words))] = rnd.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def copied():
    """Chains of edits, a large group of near copies, exact copies, passages and odd texts."""
    rnd = random.Random(4)
    docs = []
    for _ in range(40):
        text = sentence(rnd, rnd.choice([6, 30, 120, 400]))
        for _ in range(rnd.randint(1, 6)):
            docs.append(text)
            text = edited(rnd, text, rnd.choice([0, 1, 1, 2, len(text.split()) // 40]))
    base, passage = sentence(rnd, 150), sentence(rnd, 60)
    docs += [edited(rnd, base, 2) for _ in range(150)]
    docs += [f"{sentence(rnd, 40)} {passage} {sentence(rnd, 40)}" for _ in range(60)]
    docs += [base] * 30 + ["", "", None, None, "one", "one two", "ONE two", " \n "]
    rnd.shuffle(docs)
    rows = list(enumerate(docs, 100))
    return [*rows, (None, base), (None, ""), (None, "only here twice over"), (rows[5][0], rows[5][1])]


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, copied, size):
    got = near_duplicates.near_duplicates(frame(spark, copied), size).collect()
    expected = plain_components(copied, size, 80)
    assert sorted(map(tuple, got), key=str) == expected
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0


def test_more_pivots_find_the_same(spark, copied, monkeypatch):
    """Few candidates of the first turn pass, so that links must come from later ones."""
    monkeypatch.setattr(near_duplicates, "PIVOT_ROUNDS", 1)
    got = near_duplicates.near_duplicates(frame(spark, copied), 4).collect()
    assert sorted(map(tuple, got), key=str) == plain_components(copied, 4, 80)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    labels = dict(near_duplicates.components(links).collect())
    assert labels == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100}


@pytest.mark.parametrize("count", [1, 40, 400, 5000])
def test_set_sketches_lose_no_link(count):
    """The bitmaps' XOR never counts more than the shingles that only one of the sets has."""
    draw = np.random.default_rng(count)
    for apart in (0, 1, count // 20, count // 9, count):
        both, only_a, only_b = np.split(draw.integers(1, 1 << 63, count + 2 * apart, np.uint64), [count, count + apart])
        a, b = (near_duplicates.set_sketch(np.r_[both, own]) for own in (only_a, only_b))
        odd = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        assert odd <= 2 * apart and odd % 2 == 0
        assert count > 400 or apart == count or odd >= 0.8 * 2 * apart


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    for similarity in (0.8, 0.9, 0.5):
        errors = []
        for _ in range(30):
            both = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            extra = round(1000 * (1 - similarity) / similarity / 2)
            a, b = (np.r_[both, rng.integers(0, 2**63, extra, dtype=np.uint64)] for _ in range(2))
            sa, sb = near_duplicates.min_hashes(a), near_duplicates.min_hashes(b)
            odd = int(np.bitwise_count((near_duplicates.odd_sketch(sa) ^ near_duplicates.odd_sketch(sb)).view(np.uint64)).sum())
            assert (odd <= near_duplicates.most_odd_bits(0.8)) == (similarity > 0.6)
            bits, samples = near_duplicates.SKETCH_BITS, near_duplicates.SAMPLES
            errors.append(1 + bits / (4 * samples) * np.log(1 - 2 * odd / bits) - similarity)
            if similarity >= 0.8:
                assert (near_duplicates.band_keys(sa) == near_duplicates.band_keys(sb)).any()
        assert abs(np.mean(errors)) < 0.03


# Quality rules


def test_line_frequency(spark):
    rnd = random.Random(6)
    line = "Subscribe to our letter number {} for more news every day and never miss a thing again so please tell all of your friends about it"
    page = line.format(7)
    own = lambda n: sentence(rnd, n)
    docs = [(i, f"{page}\n{own(30)}", "a") for i in range(30)]
    docs += [(100 + i, f"{line.format(i)} \n{own(4)}", "a") for i in range(5)]
    docs += [(200 + i, f"{page}\n{own(3)} {own(3)}", "b") for i in range(5)]
    docs += [(300, None, None), (301, "", "a"), (None, f"{own(25)}", None), (302, own(5), "a")]
    docs += [(400, f"{own(40)}", "a")] * 40  # exact copies are one document
    got = {(r.doc_id): r for r in quality_rules.quality_rules(frame(spark, docs)).collect()}
    assert quality_rules.quality_rules(frame(spark, docs)).count() == len(docs)
    assert got[0].kept and got[0].n_left_words == got[0].n_words  # the first document keeps the line
    assert got[1].kept and got[1].n_left_words == 30
    assert all(not got[100 + i].kept and not got[100 + i].base_failed and got[100 + i].n_left_words == 4 for i in range(5))
    assert all(got[200 + i].n_left_words == got[200 + i].n_words for i in range(5))  # another host
    assert got[300].base_failed and got[301].base_failed and got[302].base_failed and not got[302].kept
    assert got[400].kept and got[None].kept
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


def test_frequent_lines_leave_the_text(spark):
    rnd = random.Random(8)
    line = "Read more of this every day 7"
    docs = [(i, f"\n{line}\n{sentence(rnd, 30)}\n\n{line.upper()} \n{WORDS[i]}\n", "a") for i in range(30)]
    docs += [(100, f"{line}\n{sentence(rnd, 30)}", "b"), (None, f"{sentence(rnd, 30)}\n{line}", "a"), (101, None, "a"), (102, "", None)]
    own = {i: text.split("\n") for i, text, _ in docs if text}
    expected = {i: "\n".join(["", own[i][2], "", WORDS[i], ""]) for i in range(1, 30)}
    expected |= {0: docs[0][1], 100: docs[30][1], None: own[None][0], 101: None, 102: ""}
    rows = quality_rules.cleaned_documents(frame(spark, docs)).collect()
    assert {r.doc_id: r.text for r in rows} == expected and len(rows) == len(docs)
    assert all(r._rules.n_left_words == len((r.text or "").split()) for r in rows)
    assert sorted((r._rules for r in rows), key=str) == sorted(quality_rules.quality_rules(frame(spark, docs)).collect(), key=str)
    staged = corpus_pipeline.quality_stage(spark, frame(spark, docs), SF)
    assert staged.columns == frame(spark, docs).columns
    assert {r.doc_id: (r.text, r.n_chars) for r in staged.collect()} == {i: (t, len(t)) for i, t in expected.items() if t}


def test_base_counts(spark):
    rnd = random.Random(7)
    texts = [None, "", "\n\n", "a " * 500, "a b c d e f g h a b c d e f g h", "x\ny\nx\n \nx", "#*$ %&| <>\t\x0b\x0c\r z", "é" * 9]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 60))) + rnd.choice(["\n", " \t", ""]) for _ in range(200)]
    rows = quality_rules.quality_rules(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    for text, r in zip(texts, rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert tuple(r)[1:6] == expected, text


def test_quality_rules_run_no_python(spark, capsys):
    quality_rules.quality_rules(frame(spark, [(1, "a")])).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


# Quality classifier


def test_classifier_on_held_out_rows(spark):
    scores = QUERIES["op8_quality_scores"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = scores.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    ranks = held["score"].rank()
    good = held["quality"] == 1
    area = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.97 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert scores["score"].between(0, 1).all() and len(scores) == 1000


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality_classifier.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (sorted(quality_classifier.quality_scores(docs, t).collect()) for t in (labels, turned))
    assert first == second


def test_classifier_on_odd_rows(spark):
    docs = frame(spark, [(1, None), (None, "a b"), (2, ""), (2, ""), (3, "x " * 30000)])
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    rows = quality_classifier.quality_scores(docs, none).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    one_class = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert all(r.score >= 0.5 for r in quality_classifier.quality_scores(docs, one_class).collect())
    assert quality_classifier.quality_scores(frame(spark, []), one_class).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(3)
    values = np.zeros((4000, len(quality_classifier.FEATURES)))
    values[:, :2] = rng.random((4000, 2))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)
    model = quality_classifier.fit_model(values, labels)
    assert ((model.scores(values) >= 0.5) == labels).mean() > 0.9


# Web captures


def test_warc_derivatives(spark):
    html = "<html><head><title> A  &amp; B</title></head><body><p>One<br>two</p><script>x<y</script><a href=\"/l\">link &lt;3</a><!-- c --></body></html>"
    rows = [(1, "u", html, "e"), (2, None, None, "e"), (3, "v", "", "e"), (1, "u", html, "e"), (None, "w", "plain & simple", "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    records = warc.derivatives(warc.responses_of(pages)).collect()
    assert len(records) == 2 * len(rows)
    first = {r.record_type: r for r in records if r.page_id == 1}
    assert first["metadata"].block == "title: A  &amp; B\r\noutlink: /l".replace("A  &", "A &")
    assert first["conversion"].block == "One\ntwo\nlink <3"
    for r in first.values():
        assert r.payload_digest == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode())
    assert first["metadata"].refers_to == first["conversion"].refers_to != first["conversion"].record_id
    binary = warc.responses_of(pages).withColumn("headers", F.lit("HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n"))
    assert {r.record_type for r in warc.derivatives(binary).collect()} == {"metadata"}
    text = warc.warc_text(warc.derivatives(warc.responses_of(pages))).first().record
    assert text.startswith("WARC/1.1\r\nWARC-Type: ") and "WARC-Refers-To: <urn:uuid:" in text
    assert warc.derivatives(warc.responses_of(pages.limit(0))).count() == 0


def test_links_in_all_quotings(spark):
    links = ["<a href=\"/a b\">", "<a class=x href='/c\"d'>", "<A HREF=/e/f>", "<a\nid=1 href = '/g'>", "<a data-href=\"/no\" href=/h?i=j>", "<a href=\"\">"]
    pages = spark.createDataFrame([(1, "u", "x".join(links))], "page_id long, url string, html string")
    block = warc.derivatives(warc.responses_of(pages)).where("record_type = 'metadata'").first().block
    assert block.split("\r\n")[1:] == [f"outlink: {x}" for x in ("/a b", "/c\"d", "/e/f", "/g", "/h?i=j", "")]


# Pipeline


def test_without_treats_null_as_a_key(spark):
    docs = frame(spark, [(1, "a"), (None, "b"), (2, "c"), (2, "d")])
    gone = spark.createDataFrame([(None,), (2,), (2,)], "doc_id long")
    assert [r.text for r in without(docs, gone).collect()] == ["a"]
    assert without(docs, gone.limit(0)).count() == 4


def test_stages_decide_by_row(spark):
    """Rows that share an id, or have none, are kept and dropped each for itself."""
    rnd = random.Random(9)
    good = [sentence(rnd, 40) for _ in range(6)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first().text

    def staged(stage, rows):
        return sorted(((r.doc_id, r.text) for r in stage(spark, frame(spark, rows), SF).collect()), key=str)

    clean = [(None, good[0]), (None, good[1]), (1, good[2]), (2, good[3])]
    bad = [(None, "too short"), (1, ""), (2, None)]
    assert staged(corpus_pipeline.quality_stage, clean + bad) == sorted(clean, key=str)
    copies = [(None, good[4]), (None, good[4]), (2, good[3]), (None, good[2]), (2, good[5]), (1, edited(rnd, good[2], 0))]
    assert staged(corpus_pipeline.duplicate_stage, clean + copies) == sorted([*clean, (None, good[4]), (2, good[5])], key=str)
    dirty = [(None, f"{good[4]} {item}"), (1, item)]
    assert staged(corpus_pipeline.decontamination_stage, clean + dirty) == sorted(clean, key=str)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = sorted(r.doc_id for r in docs.collect())
    first = [(i, texts[i]) for i in kept["quality_rules"]]
    assert kept["near_duplicates"] == sorted(i for i, _, _, least in plain_components(first, 5, 80) if least)
    second = [(i, texts[i]) for i in kept["near_duplicates"]]
    assert kept["decontamination"] == sorted(r[0] for r in plain_contamination(second, items) if not r[-1])
    assert kept["personal_data"] == kept["decontamination"]
    packed = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in packed.select("doc_id").distinct().collect()) == kept["personal_data"]


def test_stages_on_odd_tables(spark):
    rows = [(None, "a " * 30), (1, None), (1, ""), (2, "x@y.zz " + sentence(random.Random(1), 30)), (2, "x@y.zz " + sentence(random.Random(1), 30))]
    for docs in (frame(spark, rows), frame(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()
