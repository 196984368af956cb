"""Operators of the subpackage against brute force, on small frames with hard cases."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import bpe, components, decontaminate, host_rules, licences, passages, pii, simhash, token_files, toxicity, warc

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RND = random.Random(5)
WORDS = ["".join(RND.choice("abcdeiou") for _ in range(RND.randint(1, 7))) for _ in range(300)]


def prose(n: int) -> str:
    return " ".join(RND.choice(WORDS) for _ in range(n))


LONG = prose(30_000)
COPY = prose(200)
TEXTS = [
    None, "", " ", "\n\t ", "one", "Two words", COPY, COPY, COPY + " more", prose(60), "x" * 5000, LONG,
    "a  b\n c\r\n\td  ", "é ß ñ 日本語 <|endoftext|> \U0001f600 it's 12,345.6!!", "\x00\x1c odd   spaces here", "-- " * 40,
]


@pytest.fixture(scope="module")
def documents(spark):
    """Hard texts with a null key, a repeated row and columns that clash with inner names."""
    rows = [(i, t, f"s{i % 2}" if i % 5 else None, 1, 2, "k") for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, prose(20), None, 1, 2, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, row int, key int, fingerprint string").repartition(3)


@pytest.fixture(scope="module")
def empty(documents):
    return documents.where("doc_id < -1")


def test_bpe_equals_the_library_and_decodes_back(documents, empty):
    library = Tokenizer.from_file(BYTE)
    rows = bpe.encode(documents, BYTE, decoded="back").join(documents.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert (row.ids, row.back) == (ids, row.text or "")
    decoded = bpe.decode(bpe.encode(documents, BYTE), BYTE).collect()
    assert sorted(r.text for r in decoded) == sorted(r.back for r in bpe.encode(documents, BYTE, decoded="back").collect())
    assert bpe.encode(empty, BYTE).count() == 0


def test_bpe_words_by_all_three_ways():
    with open(BYTE, encoding="utf-8") as file:
        codec = bpe.Codec(bpe.tables_of(file.read()))
    words = ["".join(RND.choice("abcdefgh ") for _ in range(RND.randint(1, 120))).encode() for _ in range(400)]
    flat, count = codec.encode_words(words)
    merged, merged_count = codec.merge_all(words)
    assert (flat == merged).all() and (count == merged_count).all()
    long_way = [codec._merge_long(w) for w in words]
    assert flat.tolist() == [t for tokens in long_way for t in tokens]


def test_token_files_round_trip(spark, documents, empty, tmp_path):
    library = Tokenizer.from_file(WORD)
    token_files.write(documents, f"{tmp_path}/t", WORD, end_id=2)
    tokens = token_files.read(spark, f"{tmp_path}/t")
    rows = token_files.with_crc32(token_files.with_start(tokens)).collect()
    start = 0
    order = sorted(documents.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for want, row in zip(order, sorted(rows, key=lambda r: r.start)):
        ids = [*library.encode(want.text or "", add_special_tokens=False).ids, 2]
        assert (row.key, row.start, row.n_tokens) == (want.doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)
    token_files.write(empty, f"{tmp_path}/e", WORD, end_id=2)
    assert token_files.with_start(token_files.read(spark, f"{tmp_path}/e")).count() == 0


def _fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_hard_texts(documents, empty):
    rows = simhash.near_duplicates(documents).collect()
    assert len(rows) == len(TEXTS) + 2
    texts = dict(enumerate(TEXTS))
    assert all(r.fingerprint % 2**64 == _fingerprint(texts[r.doc_id] or "") for r in rows if r.doc_id is not None)
    root = {r.doc_id: r.component for r in rows}
    assert {root[i] for i in range(4)} == {0} and root[7] == 6
    kept = [r.doc_id for r in simhash.one_per_group(documents).collect()]
    assert kept.count(0) == kept.count(6) == kept.count(None) == 1 and not {1, 2, 3, 7} & {*kept}
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [3, 2048])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    centres = [RND.getrandbits(64) for _ in range(40)]
    prints = {c for c in centres} | {0, 2**64 - 1}
    for c in centres[:20]:
        for _ in range(20):
            prints.add(c ^ sum(1 << b for b in RND.sample(range(64), RND.randint(1, 5))))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))
    got = {r.node: r.root for r in components.components(edges).collect()}
    value = np.array(signed, dtype=np.int64).view(np.uint64)
    parent = {p: p for p in signed}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(signed):
        for j in np.flatnonzero(np.bitwise_count(value[i] ^ value) <= 3):
            a, b = find(p), find(signed[j])
            parent[max(a, b)] = min(a, b)
    assert all(got.get(p, p) == find(p) for p in signed)


def test_rows_at_anchors_are_not_broadcast(spark):
    # 34 rows of each fingerprint, which Spark sizes as one: few rows here, beyond the driver's memory at 0.5 GB of texts.
    prints = spark.range(1, 200).selectExpr("xxhash64(id) AS fingerprint")
    found = simhash.links(prints)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity_is_learned_and_survives_hard_cases(spark, documents, empty):
    rows = [(i, prose(30) + (" vilest blockhead" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.train(frame, labels.union(labels.limit(5)).union(spark.sql("SELECT 1L, CAST(NULL AS INT)")))
    scored = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert all((scored[i] >= 0.7) == bool(t) for i, _, t in rows)
    assert toxicity.without_toxic(frame, model).count() == 300
    assert all(0 <= r.score <= 1 for r in toxicity.score(documents, model).collect())
    assert toxicity.score(empty, model).count() == 0 and toxicity.without_toxic(documents, model).columns == documents.columns
    nothing = toxicity.train(frame, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(documents, nothing).collect()} == {0.0}


def _plain_spans(text: str) -> list[tuple[int, int, int]]:
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, (pattern, good) in enumerate(rules) for m in re.finditer(pattern, text) if good(m[0])]


def test_labels_without_a_document_leave_the_model_as_it_is(spark):
    docs = spark.createDataFrame([(i, f"{prose(30)} {'awful nasty words' if i % 2 else ''}") for i in range(300)], "doc_id long, text string")
    own = [(i, i % 2) for i in range(300)]
    plain = toxicity.train(docs, spark.createDataFrame(own, "doc_id long, toxic int"), most_rows=300)
    more = toxicity.train(docs, spark.createDataFrame(own + [(i, i % 2) for i in range(1000, 6000)], "doc_id long, toxic int"), most_rows=300)
    assert len(plain.at) > 1 and plain.at.tolist() == more.at.tolist() and plain.weight.tolist() == more.weight.tolist()


def test_toxicity_is_learned_from_all_labelled_rows(spark):
    # Each word stands in as many documents as a learner has rows, so none of the learners alone would know all.
    rows = [(i, f"{prose(20)} nasty{i % 8} blockhead{i % 8}" if i % 2 else prose(20), i % 2) for i in range(1600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    first = {r.doc_id for r in frame.orderBy(order).limit(400).collect()}
    # All toxic rows but the four hundred of smallest hash have a word that these have not.
    own = F.when(F.col("doc_id").isin(list(first)), F.col("text")).otherwise(F.regexp_replace("text", "nasty|blockhead", "rotten"))
    model = toxicity.train(frame.withColumn("text", own), labels, most_rows=400)
    seen = spark.createDataFrame([(1, "rotten1 rotten1 rotten1")], "doc_id long, text string")
    blank = spark.createDataFrame([(1, "")], "doc_id long, text string")
    score = lambda df: toxicity.score(df, model).first().score
    assert score(seen) > score(blank) + 0.2
    # Learners with a single kind of label don't spoil the others.
    few = toxicity.train(frame, labels.withColumn("toxic", (F.col("doc_id") == 1).cast("int")), most_rows=400)
    assert len(few.at) and np.isfinite(few.weight).all()


def test_toxicity_of_many_learners_is_as_sure_as_that_of_one(spark):
    # A learner sees each of the words in so few rows that it gives them little weight, or none.
    rows = [(i, prose(20) + (f" rotten{i % 30 // 6}" if i % 6 == 0 else ""), int(i % 6 == 0)) for i in range(2400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame, frame.select("doc_id", "toxic").where(~toxicity.held_out()), most_rows=200)
    apart = frame.where(toxicity.held_out())
    scored = toxicity.score(apart, model).join(apart, "doc_id").collect()
    assert sum(r.toxic for r in scored) > 100 and all((r.score >= 0.7) == bool(r.toxic) for r in scored)


def test_slope_and_intercept_are_those_of_the_largest_likelihood():
    step, rows = np.array([-128.0, -64, 0, 64, 128]), np.array([50_000, 20_000, 20_000, 20_000, 50_000.0])
    hits = rows / (1 + np.exp(-(3 * step * toxicity.STEP - 1)))
    assert toxicity.platt(step, hits, rows) == pytest.approx((3, -1), abs=0.01)
    assert toxicity.platt(step, hits[::-1], rows) == (1, 0)


def test_base_spans_equal_the_patterns():
    parts = ["a.b+c", "@", "mail-1.example", ".com", "192.168.0.1", ".", "999.1.1.1", " ", "4111 1111 1111 1111", "+49 (30) 1234-567", "+", "1", "-", "é", "00000255.1.2.3", "x"]
    for _ in range(4000):
        text = "".join(RND.choice(parts) for _ in range(RND.randint(0, 14)))
        assert pii.base_spans(text) == _plain_spans(text), text
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@b.c") == [(0, 0, 200_004)]


def test_personal_data_is_found_and_redacted(spark, documents, empty):
    rows = [(i, f"{prose(5)} mail me{i}@mail.example.com or +1 (555) 010-{1000 + i} id {RND.randint(10**7, 10**8)}x {prose(5)}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(frame)
    for row in found.collect():
        assert [tuple(s) for s in row.base] == _plain_spans(rows[row.doc_id][1])
    clean = [r.text for r in pii.redact(frame, found).collect()]
    assert len(clean) == 200 and all("[email]" in t and "[phone]" in t and "@" not in t for t in clean)
    odd = pii.find(documents)
    assert odd.count() == len(TEXTS) + 2 and pii.find(empty).count() == 0
    assert pii.fit(pii.propose(documents)) is None
    assert sorted(t or "" for (t,) in pii.redact(documents, odd).select("text").collect()) == sorted(t or "" for (t,) in documents.select("text").collect())


def test_selector_learns_from_all_spans(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    features = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (i + F.col("id") % 2).cast("double"))
    proposed = F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("start"), F.lit(1).alias("end"), (F.col("id") % 2).cast("double").alias("label"), F.lit(False).alias("free"), features.alias("features")))
    found = spark.range(24_000).select(F.col("id").alias("row"), proposed.alias("proposed"))
    rows, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: rows.append(df.count()) or fit(self, df))
    assert pii.fit(found) is not None
    assert rows == [found.where(F.pmod(F.xxhash64("row", F.lit(0), F.lit(1), F.lit(0)), F.lit(4)) != 0).count()] and rows[0] > 15_000


def test_loose_personal_data_is_added(spark):
    token = lambda: "".join(RND.choice("0123456789abcdef") for _ in range(32))
    rows = [(i, f"{prose(5)} me{i}@mail.example.com {prose(4)} +1 ({RND.randint(200, 999)}) 555-{RND.randint(1000, 9999)} {prose(4)} token = {token()} {prose(3)} order {RND.randint(10**9, 10**10)} {prose(3)}") for i in range(200)]
    loose = ["jane.doe [at] mail [dot] example [dot] org", "jane(at)host.example.org", "(663) 555-6869", "555-123-4567"]
    rows += [(1000 + i, f"{prose(6)} {loose[i % 4]} {prose(6)} token = {token()} {prose(2)}") for i in range(40)]
    found = {r.doc_id: [rows_text[s.start : s.end] for s in r.added] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect() for rows_text in [dict(rows)[r.doc_id]]}
    assert all(loose[i % 4] in found[1000 + i] for i in range(40))
    assert sum(len(found[i]) for i in range(200)) <= 10


def test_host_rules(spark, documents, empty):
    text = "\n".join([COPY, COPY, "same line", "same line", "", "#$% |"])
    frame = spark.createDataFrame([(i, text if i < 8 else prose(30), "bad" if i < 10 else None) for i in range(40)], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in host_rules.judge(frame).collect()}
    words = text.split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert (rows[0].n_repeat_words, rows[0].n_dup_lines, rows[0].n_symbols) == (len(inside), 2, 4)
    assert rows[0].word_chars == sum(map(len, words)) and rows[0].base_failed
    assert not rows[9].base_failed and not rows[9].kept and rows[20].kept
    judged = host_rules.judge(documents).collect()
    assert len(judged) == len(TEXTS) + 2 and all(r.n_words == len(re.findall(r"[^\x20\x09-\x0D]+", TEXTS[r.doc_id] or "")) for r in judged if r.doc_id is not None)
    assert host_rules.judge(empty).count() == 0


def test_repeated_words_across_texts():
    rows = [[RND.choice([b"a", b"b"]) for _ in range(RND.randint(0, 40))] for _ in range(200)]
    got = host_rules.repeated_words(rows)
    for words, n in zip(rows, got):
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        assert n == len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


def test_warc_round_trip(spark, tmp_path):
    big = "é<p>" + prose(300)
    rows = [(1, "http://a/\r\nb", big), (2, None, big), (3, "http://c/", big + "!"), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", big), (2, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", pytest.importorskip("pyspark.sql.functions").lit("x"))
    archives = warc.write(pages.repartition(3), f"file://{tmp_path}/w")
    records = warc.read(archives).collect()
    assert len(records) == len(rows)
    for r in records:
        payload = next((h or "") for k, _, h in rows if k == r.key).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisit = r.key in (1, None)
        assert (r.record_type, r.refers_to, r.payload) == (("revisit", 2, None) if revisit else ("response", None, payload))
    assert warc.read(warc.write(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_zip64_directories_are_parsed(tmp_path):
    import zipfile

    import pyarrow as pa

    path = f"{tmp_path}/z.zip"
    with zipfile.ZipFile(path, "w") as package:
        for i in range(70_000):
            package.writestr(f"m{i}", b"%d" % i)
    with pa.OSFile(path) as file:
        found = warc.members(file, file.size())
        assert len(found) == 70_000 and all(file.read_at(found[f"m{i}"][1], found[f"m{i}"][0]) == b"%d" % i for i in (0, 65_535, 69_999))


def test_decontamination_equals_brute_force(spark, documents, empty):
    passage = prose(25)
    items = [(1, passage), (2, "Tiny bit"), (3, None), (4, ""), (5, passage + " tail"), (6, prose(40)), (6, passage), (7, "lone")]
    frame = documents.select("doc_id", "text").union(spark.createDataFrame([
        (90, f"{prose(9)} {passage.upper()}, {prose(4)}"), (91, passage[: len(passage) // 2]), (92, "a tiny, BIT x tiny bit"), (93, f"{passage} {passage}"), (94, "lone"),
    ], "doc_id long, text string"))
    got = {(r.doc_id, r.n_words): r for r in decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for key, text in frame.collect():
        words, hit, names = cut(text), set(), set()
        if len(words) < 20_000:
            for item, body in items:
                own = cut(body)
                n = min(10, len(own))
                windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
                for i in range(len(words) - n + 1 if own else 0):
                    if tuple(words[i : i + n]) in windows:
                        hit |= {*range(i, i + n)}
                        names.add(str(item))
            row = got[key, len(words)]
            assert (row.n_hit, row["items"], row.contaminated) == (len(hit), sorted(names), bool(hit)), key
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(frame, no_items).where("contaminated").count() == 0
    assert decontaminate.contamination(empty, no_items).count() == 0


def test_passages_are_found_and_clean_documents_left_alone(spark, documents, empty):
    shared = [RND.choice(WORDS) + str(RND.randint(0, 999)) for _ in range(70)]
    edited = shared[:30] + ["changed", "here"] + shared[31:]
    unique = lambda n: " ".join(f"{RND.choice(WORDS)}{RND.randint(0, 10**6)}" for _ in range(n))
    rows = [(i, unique(80)) for i in range(20)]
    rows += [(i, f"{unique(20)} {' '.join(edited if i % 2 else shared)} {unique(15)}") for i in range(100, 110)] + [(None, " ".join(shared)), (200, " ".join(shared[:30]))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").withColumn("x", pytest.importorskip("pyspark.sql.functions").lit(1))).collect()
    assert {r.doc_id for r in found} | {r.other for r in found} == {*range(100, 110)}
    assert all(r.end - r.start >= 69 and r.similarity > 0.9 for r in found)
    copies = {(r.doc_id, r.other) for r in passages.repeated_passages(documents).collect()}
    assert {(7, 6), (8, 6)} <= copies and passages.repeated_passages(empty).count() == 0


def _unlike(words, n):
    return [f"{RND.choice(words)}{RND.randint(0, 10**9)}" for _ in range(n)]


def test_fuzzy_passages_are_found_down_to_the_stated_similarity(spark):
    rows, edits = [], {}
    cases = [(55, (5, 50)), (50, (0, 49)), (50, tuple(range(4, 50, 5))), (60, tuple(range(2, 60, 5))), *((n, tuple(RND.sample(range(n), n // 5))) for n in (50, 55, 60, 80, 120) for _ in range(10))]
    for i, (n, changed) in enumerate(cases):
        passage = _unlike(WORDS, n)
        edited = [f"changed{i}x{p}" if p in changed else w for p, w in enumerate(passage)]
        rows += [(2 * i, " ".join(_unlike(WORDS, 70) + passage + _unlike(WORDS, 70))), (2 * i + 1, " ".join(_unlike(WORDS, 66) + edited + _unlike(WORDS, 75)))]
        edits[2 * i + 1] = 1 - len(changed) / n
    # 50 words with 11 changed are below the similarity.
    passage = _unlike(WORDS, 50)
    rows += [(1000, " ".join(_unlike(WORDS, 60) + passage + _unlike(WORDS, 60))), (1001, " ".join(_unlike(WORDS, 60) + [f"new{p}" if p % 5 == 0 or p == 27 else w for p, w in enumerate(passage)] + _unlike(WORDS, 60)))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other) for r in found} == {(k, k - 1) for k in edits}
    texts = {k: t.split() for k, t in rows}
    for r in found:
        a, b = texts[r.doc_id][r.start : r.end], texts[r.other][r.other_start : r.other_end]
        assert min(len(a), len(b)) >= 50 and r.similarity >= 0.8 and abs(r.similarity - 2 * passages.common(a, b) / (len(a) + len(b))) < 1e-9


def test_passages_whose_parts_others_hold_are_linked(spark):
    rows, pairs, texts = [], set(), lambda *parts: " ".join(w for part in parts for w in part)
    for i in range(0, 1000, 100):
        passage = _unlike(WORDS, 60)
        own = lambda: _unlike(WORDS, 60)
        rows += [(i, texts(own(), passage[:45], own())), (i + 1, texts(own(), passage[15:], own()))]
        rows += [(i + 2, texts(own(), passage, own())), (i + 3, texts(own(), passage, own()))]
        # Lines that twelve others hold each, and lines with a holder each and changed words.
        lines = [_unlike(WORDS, 10) for _ in range(6)]
        rows += [(i + 10 + 6 * j + n, texts(own(), line, own())) for j in range(12) for n, line in enumerate(lines)]
        rows += [(i + 90, texts(own(), *lines, own())), (i + 91, texts(own(), *lines, own()))]
        fuzzy = [_unlike(WORDS, 20) for _ in range(3)]
        rows += [(i + 4 + n, texts(own(), line, own())) for n, line in enumerate(fuzzy)]
        rows += [(i + 92, texts(own(), *fuzzy, own())), (i + 93, texts(own(), *([*line[:9], "new", *line[10:]] for line in fuzzy), own()))]
        pairs |= {(i + 3, i + 2), (i + 91, i + 90), (i + 93, i + 92)}
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert pairs <= {(r.doc_id, r.other) for r in found if r.end - r.start >= 60}


def test_passages_with_a_later_holder_of_common_seeds_are_found(spark):
    # The only runs of 4 words that 20 shares with 21 are those of a line that ten earlier documents hold.
    def some(n):
        return ["".join(RND.choices("abcdefghij", k=9)) for _ in range(n)]

    line, tail = some(13), some(39)
    changed = [x if i % 4 else y for i, (x, y) in enumerate(zip(tail, some(39)))]
    rows = [(i, " ".join([*some(40), *line, *some(40)])) for i in range(10)]
    rows += [(20, " ".join([*some(30), *line, *tail, *some(30)])), (21, " ".join([*some(25), *line, *changed, *some(35)]))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.end, r.other, r.other_start, r.other_end) for r in found] == [(21, 25, 77, 20, 30, 82)]
    found = passages.repeated_passages(spark.createDataFrame([(str(k), t) for k, t in rows], "doc_id string, text string")).collect()
    assert [(r.doc_id, r.other) for r in found] == [("21", "20")]


def test_words_around_two_places_hold_a_passage_if_aligning_them_finds_one():
    rng, n, seen = np.random.default_rng(5), passages.MARGIN, [0, 0]
    for _ in range(300):
        x = rng.integers(0, 400, 2 * n + passages.K)
        change = rng.random(len(x)) < rng.choice([0.1, 0.2, 0.3])
        y = np.where(change, rng.integers(0, 400, len(x)), x)
        cut = rng.random(len(y)) < rng.choice([0.0, 0.1])
        y[n : n + passages.K], cut[n : n + passages.K] = x[n : n + passages.K], False
        at = n - int(cut[:n].sum())
        low, high = (0, len(x)) if rng.random() < 0.5 else (n - 20, n + 40)
        x, y = x[low:high], y[~cut]
        own = (n - low, n - low + passages.K, at, at + passages.K)
        a, b = x.tolist(), y.tolist()
        x0, x1, y0, y1, like = passages.align(a, b, list(own))
        codes = np.full((2, 2 * n + passages.K), -1, dtype=np.int32)
        codes[0, n - own[0] : n - own[0] + len(a)] = a
        codes[1, n - own[2] : n - own[2] + len(b)] = b
        finds = like >= passages.SIMILARITY and min(x1 - x0, y1 - y0) >= passages.LEAST
        assert passages.holds_passage(codes[:1], codes[1:])[0] == finds
        i, j = np.array([0]), np.array([1])
        near = passages._common(*passages._bits(np.where((codes[:, :-1] >= 0) & (codes[:, 1:] >= 0), codes[:, :-1] << 15 | codes[:, 1:], -1)), i, j)
        words = passages._common(*passages._bits(codes), i, j)
        assert not finds or near[0] >= passages.PAIRED and words[0] >= passages.ALIKE
        seen[finds] += 1
    assert min(seen) > 30


def test_common_subsequence_by_table():
    for _ in range(200):
        a, b = ([RND.choice("abc") for _ in range(RND.randint(1, 30))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert passages.common(a, b) == best[-1][-1]


def test_licenses(spark, documents, empty):
    lines = [(1, f"{prose(30)}\nReleased under the MIT License.\n{prose(10)}"), (2, "LICENSED under: the Apache license version 2.0"), (3, prose(40)), (4, None), (5, "mit license")]
    found = licences.scan(spark.createDataFrame(lines, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line, r.license, r.dice) for r in found} == {(1, 2, "MIT", 1.0), (2, 1, "Apache-2.0", 1.0)}
    assert licences.scan(documents).count() == 0 and licences.scan(empty).count() == 0 and licences.scan(documents, {}).count() == 0


def test_packed_seeds_take_few_bytes_and_come_back(spark):
    """Seeds and links travel packed: a few bytes a seed, so that they take less disk than the texts they are of."""
    texts = [" ".join(_unlike(WORDS, 300)) for _ in range(200)]
    texts += [None, "", "too short", texts[0], " ".join(texts[1].split()[40:120] + _unlike(WORDS, 30))]
    frame = spark.createDataFrame(list(enumerate(texts)), "key long, text string").coalesce(1)
    rows = passages.seeds(frame, 3).collect()
    assert sum(len(r.packed) for r in rows) < 8 * sum(r.size for r in rows) and {r.part for r in rows} == {0, 1, 2}
    assert sum(r.size for r in rows) == sum(len(set(zip(*[iter_[k:] for k in range(4)]))) + n for iter_, n in _seed_counts(texts))
    linked = passages.links(passages.seeds(frame, 3), 5).collect()
    import pyarrow as pa

    held = {key for r in linked for key in passages._unpack_keys(pa.array([], pa.int64()), r.numbers, r.held).to_pylist()}
    assert held == {0, 203, 1, 204}


def test_keys_of_all_kinds_are_packed_and_come_back(spark):
    import pyarrow as pa

    for keys in ([5, -3, 2**63 - 1, -(2**63), 0, 7], list(range(1000)), ["b", "", "a"]):
        keys = pa.array(keys)
        rest, numbers = passages._pack_keys(keys)
        assert passages._unpack_keys(rest, numbers, len(keys)).equals(keys)
    shared = " ".join(_unlike(WORDS, 60))
    for kind, keys in (("string", ["b", "a"]), ("int", [2, -1])):
        found = passages.repeated_passages(spark.createDataFrame([(k, shared) for k in keys], f"doc_id {kind}, text string")).collect()
        assert [(r.doc_id, r.other, r.end, r.similarity) for r in found] == [(keys[0], keys[1], 60, 1.0)]


def _seed_counts(texts):
    """Words of each text with passages, and its distinct long seeds by the plain rule: the first smallest one of each window."""
    from textloom.llm.decontaminate import word_hashes

    for text in texts:
        words = (text or "").lower().encode().split()
        if len(words) >= passages.LEAST:
            long = passages._mixed(word_hashes([words]), passages.LONG).tolist()
            size = min(passages.WINDOW, len(long))
            yield words, len({min(range(i, i + size), key=lambda p: (long[p], p)) for i in range(len(long) - size + 1)})


def test_matches_and_pieces_of_many_pairs_are_those_of_each(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    pair, x, y = rng.integers(0, 30, 900), rng.integers(0, 60, 900), rng.integers(0, 60, 900)
    y = np.where(rng.random(900) < 0.05, -1 - y, y)
    order = np.lexsort((y, x, pair))
    pair, x, y = pair[order], x[order], y[order]
    own, *found = passages.blocks(*passages.matches(pair, x, y))
    for p in range(30):
        alone = passages.blocks(*passages.matches(pair[pair == p], x[pair == p], y[pair == p]))[1:]
        assert all((a == b[own == p]).all() for a, b in zip(alone, found))
        points = {(i, j) for i, j in zip(x[pair == p], y[pair == p]) if j >= 0}
        points |= {(i + k, -1 - j + k) for i, j in zip(x[pair == p], y[pair == p]) if j < 0 for k in range(passages.LONG - passages.K + 1)}
        assert {(a + k, b + k) for a, b, n in zip(*alone) for k in range(n)} == points


def test_most_words_of_the_best_score_by_submatrix():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(50):
        table = rng.integers(-90, 60, tuple(rng.integers(1, 12, 2)))
        assert passages._most(table).tolist() == [table[n:, n:].max() for n in range(min(table.shape))]
