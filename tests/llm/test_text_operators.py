"""The text operators against brute force, round trips and held-out labels."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from obslake.llm import extraction, lm, minhash, packing, pieces, pivots, toxicity, winnowing
from obslake.llm.chat import format_conversations, parse_conversations
from obslake.llm.common import held_out, labelled_sample
from obslake.llm.extraction import extract_text, page_blocks
from obslake.llm.quality import score_quality, train_quality
from obslake.llm.queries import byte_vocabulary, piece_model

SMALL = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, length string, node int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def odd_docs(spark):
    """Null, empty, blank, very long, repeated and accented texts; clashing names."""
    near = " ".join(f"t{i}" for i in range(100))
    rows = [
        (1, None, "a", 1), (2, "", "a", 1), (3, " \n\t ", "a", 1), (4, LONG, "a", 1),
        (5, "one two", "a", 1), (5, "one two", "a", 1), (6, "ONE  two", "b", None),
        (None, "one two", None, 2), (7, "é ñ 中文 😀 don't\r\n  x", None, 3),
        (8, near, "", 1), (9, near + " end", "", 1), (10, LONG + " more", "", 1),
    ]
    return spark.createDataFrame(rows, ODD)


def values(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_packing_is_whole_and_gapless(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_vocabulary())
    named = "a<|endoftext|>b  <|endoftext|> <|endoftext|><|endoftext|>\n<|endoftext | it's"
    special = spark.createDataFrame([(11, named, "", 0), (12, "<|endoftext|>" * 40, "", 0)], ODD)
    docs = odd_docs(spark).where("doc_id is null or doc_id not in (4, 10)").unionAll(special)
    packed = packing.pack_documents(docs, byte_vocabulary(), sequence=16).collect()
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in packed:
        ids = [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, 0]
        part = np.array(ids[row.start : row.start + row.length], "<u4")
        assert row.doc_tokens == len(ids) and row.ids_crc32 == zlib.crc32(part.tobytes())
    sequences = {}
    for row in packed:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
    assert packing.pack_documents(docs.limit(0), byte_vocabulary()).count() == 0


def test_first_fit_equals_a_plain_scan():
    lengths = np.sort(np.random.default_rng(1).integers(1, 65, 300))[::-1]
    bins, offsets = packing.first_fit(lengths, 64)
    rooms = []
    for length, found, offset in zip(lengths, bins, offsets):
        plain = next((i for i, room in enumerate(rooms) if room >= length), len(rooms))
        if plain == len(rooms):
            rooms.append(64)
        assert (plain, 64 - rooms[plain]) == (found, offset)
        rooms[plain] -= length


def components_by_brute_force(texts, size, percent):
    sets = {}
    for key, text in texts:
        words = minhash.words_of((text or "").encode())
        n = min(size, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {(key, len(sets[key]), root(key), root(key) == key) for key in keys}


@pytest.mark.parametrize("leaf", [4096, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(minhash, "LEAF", leaf)
    base = [f"w{i}" for i in range(120)]
    rng = np.random.default_rng(2)
    texts = [(row.doc_id, row.text) for row in documents(spark).limit(60).collect()]
    for i in range(40):  # a group of near copies, some of them too far from each other
        words = list(base)
        for at in rng.integers(0, 120, i % 6):
            words[at] = f"x{i}"
        texts.append((10_000 + i, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, 85)
    wanted = components_by_brute_force(texts, 3, 85)
    assert {tuple(row) for row in found.collect()} == wanted


def test_near_duplicates_of_odd_rows(spark):
    found = minhash.near_duplicates(odd_docs(spark), 3, 85)
    got = values(found, "doc_id", "component_id", "kept")
    pairs = {(doc_id, component) for doc_id, component, _ in got}
    assert {(1, 1), (2, 2), (3, 3), (5, 5), (6, 5), (8, 8), (9, 8), (4, 4), (10, 4)} <= pairs
    assert (None, None, True) in got and len(got) == 12
    assert minhash.near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    near = base[:30] + 0.02 * rng.standard_normal((30, 16))
    hot = base[0] + 0.02 * rng.standard_normal((50, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, hot]))]
    rows += [(200, rows[0][1]), (201, [2 * x for x in rows[0][1]]), (202, None), (203, [])]
    rows += [(204, [0.0] * 16), (205, [float("nan")] * 16), (206, [1.0, 2.0]), (None, rows[0][1])]
    found = pivots.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    units = {i: pivots.unit(v) for i, v in rows if i is not None}
    able = {i: u for i, u in units.items() if u is not None and len(u) == 16}
    links = {i: [j for j in able if j != i and able[i] @ able[j] >= 0.95] for i in able}
    got = {row.vec_id: row for row in found.collect()}
    assert len(got) == len(rows)
    for i in units:
        near_ids = links.get(i, [])
        assert got[i].n_links == len(near_ids)
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert got[i].component_id == min(seen) and got[i].kept == (i == min(seen))
    assert got[None].n_links == 0 and got[None].component_id is None


def test_conversations_come_back(spark):
    hard = ["\\### Assistant: </turn> ok", "\\h\\\\e", "a\\", "</turn>\n### user: x", "####", "", None]
    rows = [(i, 0, "user", text, "z") for i, text in enumerate(hard)]
    rows += [(i, 1, "assistant", text, "z") for i, text in enumerate(hard)]
    rows += [(None, None, None, None, ""), (0, 2, "a: b\\</turn>", "é" * 50_000, "")]
    frame = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, formatted string"
    )
    back = parse_conversations(format_conversations(frame)).collect()
    got = {row.conv_id: [(t.role, t.text, t.learned) for t in row.turns] for row in back}
    for i, text in enumerate(hard):
        assert got[i][:2] == [("user", text or "", None), ("assistant", text or "", text or "")]
    assert got[0][2][:2] == ("a: b\\</turn>", "é" * 50_000) and got[None] == [("", "", None)]
    assert format_conversations(frame.limit(0)).count() == 0


def test_winnowing_marks_and_edits(spark):
    docs = odd_docs(spark).where("doc_id is not null")
    found = {r.doc_id: r for r in winnowing.fingerprints_with_edits(docs).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        if doc_id != 5:
            assert found[doc_id].edited == text[: len(text) - half] + following[:half]
        assert found[doc_id].n_chars == len(text)
    assert found[1].marks == [] and found[1].near_next >= 0
    # The shared beginning of two long texts is marked alike; marks rise in position.
    low = (1 << 31) - 1
    marks = [(low - (m & low), m >> 31) for m in found[4].marks]
    assert [p for p, _ in marks] == sorted(p for p, _ in marks)
    assert all(b - a <= winnowing.WINDOW for (a, _), (b, _) in zip(marks, marks[1:]))
    assert len(set(found[4].marks) & set(found[10].marks)) >= len(marks) - 2
    repeated = spark.createDataFrame([(1, "a b c d e " * 40)], "doc_id long, text string")
    same = winnowing.with_marks(repeated, "text", "marks").first().marks
    hashes = [m >> 31 for m in same]
    least = [low - (m & low) for m, h in zip(same, hashes) if h == min(hashes)]
    assert all(b - a >= 5 for a, b in zip(least, least[1:]))  # rightmost of equal hashes
    assert winnowing.fingerprints_with_edits(docs.limit(0)).count() == 0


def test_hidden_markov_scores(spark):
    docs = odd_docs(spark).withColumn("held_out", F.coalesce(F.col("doc_id") == 9, F.lit(True)))
    found = lm.score_texts(docs).collect()
    counts = Counter()
    for row in docs.collect():
        if not row.held_out:
            counts.update(lm.tokens_of((row.text or "").encode()))
    n, v = sum(counts.values()), len(counts)
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    assert len(found) == 12
    for row in found:
        words = lm.tokens_of(texts[row.doc_id].encode())
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert row.n_tokens == len(words) and row.train_tokens == n
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(base) and row.score < 0
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(4)
    k, symbols = lm.STATES, 5
    model = lm.Model(
        rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k)),
        rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(symbols), k).T,
    )
    lengths = np.array([1, 7, 4 * lm.SPAN + 3, 0, 5 * lm.SPAN, 2])
    seen = rng.integers(0, symbols, lengths.sum())
    got, at = lm.log_likelihood(model, seen, lengths), 0
    for length, value in zip(lengths, got):
        state, total = None, 0.0
        for symbol in seen[at : at + length]:
            state = (model.start if state is None else state @ model.step) * model.emit[symbol]
            total += np.log(state.sum())
            state = state / state.sum()
        at += length
        assert value == pytest.approx(total)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(6)
    seen = np.concatenate([rng.integers(0, 5, 400), rng.integers(5, 10, 400)])
    lengths = np.array([400, 400])
    emit = rng.dirichlet(np.ones(10), lm.STATES).T
    even = np.full(lm.STATES, 1 / lm.STATES)
    model = lm.Model(even, even, np.full((lm.STATES, lm.STATES), 1 / lm.STATES), emit)
    before = lm.log_likelihood(model, seen, lengths).sum()
    for _ in range(5):
        found = lm.Expected.none(10)
        lm.expect(model, seen, lengths, found)
        assert found.emit.sum() == pytest.approx(800, rel=1e-3)
        model = lm.improve(found, np.full(10, 0.1))
    assert lm.log_likelihood(model, seen, lengths).sum() > before


def test_pieces_come_back_and_equal_a_plain_viterbi(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id not in (4, 10)")
    coded = pieces.encode_texts(docs, piece_model())
    back = {r.doc_id: r for r in pieces.decode_texts(coded, piece_model()).collect()}
    model = pieces._model(piece_model())
    known = {
        model.id_to_piece(i): (model.get_score(i), i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    zero = model.piece_to_id("<0x00>")
    for row in docs.collect():
        codes = []
        for word in row.text.split(" ") if row.text else []:
            word, best = "▁" + word, [(0.0, [])]
            for end in range(1, len(word) + 1):
                ways = []
                for start in range(end):
                    part = word[start:end]
                    if part in known:
                        score, code = known[part]
                        ways.append((best[start][0] + score, best[start][1] + [code]))
                    elif len(part) == 1:
                        raw = part.encode()
                        cost = best[start][0] - pieces.BYTE_COST * len(raw)
                        ways.append((cost, best[start][1] + [zero + b for b in raw]))
                best.append(max(ways))
            codes += best[-1][1]
        assert back[row.doc_id].codes == codes and back[row.doc_id].text == (row.text or "")


def test_html_blocks_and_repeats(spark):
    page = (
        "<html><head><title>T</title></head><body><header>Top</header><div class='cookie-notice'>"
        "C</div><main><nav>x</nav><article><h1>A &amp; B</h1><p>one<br>two <b>th</b>ree<p>four"
        "<aside>side</aside><div class=comments><p>bah</p></div><form>f</form></article></main>"
        "<script>var a='<p>no</p>';</script><footer>&copy;</footer>"
    )
    kept = [text for zone, text in page_blocks(page) if zone == 3]
    assert kept == ["A & B", "one two three", "four"]
    chrome = "<div>Home page news sport weather travel shop now</div>"
    rows = [
        (i, f"http://h/{i}", f"{chrome}<div>Body number {i} says {'word%d ' % i * 20}</div>", 1)
        for i in range(5)
    ]
    rows += [(7, None, None, 1), (8, "x", "", 1), (9, "u", "<p>cut off <b", 1), (9, "u", "<p>cut off <b", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, page int")
    got = values(extract_text(frame), "page_id", "text")
    assert [t for i, t in got if i < 5] == [
        f"Body number {i} says " + " ".join([f"word{i}"] * 20) for i in range(5)
    ]
    assert (7, "") in got and (8, "") in got and got.count((9, "cut off")) == 2
    assert extract_text(frame.limit(0)).count() == 0


def test_segments_equal_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(200):
        scores = [float(s) if s > 0 else -toxicity.COST for s in rng.integers(-6, 4, 30)]
        found = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0])
        best = max((sum(scores[a:b]) for a in range(30) for b in range(a + 1, 31)), default=0)
        if best > 0:
            assert max(score for _, _, score in found) == pytest.approx(best)
        for start, end, score in found:
            assert score == pytest.approx(sum(scores[start:end])) and score > 0


def test_trained_scores_on_held_out_rows_and_odd_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = odd_docs(spark)
    held = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    model = train_quality(docs, labels)
    scored = score_quality(docs, model).select("doc.doc_id", "score").join(held, "doc_id").collect()
    right = sum((row.score >= 0.3) == bool(row.quality) for row in scored)
    assert right >= 0.95 * len(scored)
    assert score_quality(odd, model).select("doc.*", "score").count() == 12
    assert score_quality(odd.limit(0), train_quality(odd, labels.limit(0))).count() == 0
    model = toxicity.train_toxicity(docs, labels)
    scored = toxicity.toxic_passages(docs, model).select("doc.doc_id", "score")
    rows = scored.join(held, "doc_id").collect()
    assert sum((row.score >= 0.5) == bool(row.toxic) for row in rows) >= 0.93 * len(rows)
    assert toxicity.toxic_passages(odd, model).select("doc.*", "score").count() == 12
    none = toxicity.train_toxicity(odd, labels.limit(0))
    assert {row.score for row in toxicity.toxic_passages(odd, none).collect()} == {0.5}


def test_pipeline_stages_keep_columns(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = documents(spark)
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns
        assert 0 < after.count() <= docs.count()
    kept = pipeline.keep_one_of_each(spark, odd_docs(spark), SMALL)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert pipeline.run(spark, SMALL).count() > 0


def test_host_repeats_decide_pages_with_articles(spark):
    """What most pages of a host repeat inside their articles goes; shared paragraphs stay."""
    shared = "A paragraph that every page quotes and that is as long as prose usually is " * 2
    rows = [
        (i, f"http://h/{i}", "<article><h1>Title of page %d</h1><p>%s</p><p>%s</p><p>%s</p></article>" % (
            i,
            f"own{i} " * 20,
            "Share this story with all of your friends",
            shared if i < 4 else "Only two of the pages say so here" if i < 6 else f"end{i}",
        ))
        for i in range(8)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = dict(values(extract_text(frame), "page_id", "text"))
    for i in range(8):
        last = shared.strip() if i < 4 else "Only two of the pages say so here" if i < 6 else f"end{i}"
        own = " ".join([f"own{i}"] * 20)
        assert got[i] == f"Title of page {i}\n\n{own}\n\n{last}"


def test_pages_in_many_chunks_are_judged_together(spark, monkeypatch, capsys):
    """However many shortened prefixes agree by chance, and without a shuffle of the blocks."""
    shared = " ".join(f"shared{i}" for i in range(20))
    rows = [(None, None, None), (-1, "http://h0/x", "<p>alone"), (-2, None, "")]
    for i in range(60):
        own = " ".join(f"own{i}x{k}" for k in range(20))
        page = f"<div>Home of all pages and more here</div><p>{own}</p><p>{shared}</p><div>end {i}</div>"
        rows.append((i, f"http://h{i % 2}/{i}", page))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    whole = values(extract_text(frame), "page_id", "text")
    assert dict(whole)[7].startswith("own7x0 ") and shared not in dict(whole)[7]
    monkeypatch.setattr(extraction, "CHUNK_TOKENS", 300)
    for spare in (-9, 4, 48):
        monkeypatch.setattr(extraction, "SPARE", spare)
        found = extract_text(frame)
        assert values(found, "page_id", "text") == whole
    found.explain()
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan and not re.search(r"Exchange hashpartitioning.*\n.*FileScan", plan)


def test_hidden_markov_learns_states_of_rare_words(spark):
    """Words beyond any fixed number of common ones tell the states apart, too."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1500):
        group = "ab"[i % 2]
        words = " ".join(f"{group}{w}" for w in rng.integers(0, 8000, 100))
        rows.append((i, i >= 1400, words))
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    found = lm.score_texts(docs).where("held_out").collect()
    tokens = sum(row.n_tokens for row in found)
    # The best is a factor of two for each word: its group is known from the others.
    assert sum(row.score - row.base_score for row in found) / tokens > 0.2


def test_hidden_markov_learns_alike_from_any_order(spark):
    docs = documents(spark).select("doc_id", "text")
    docs = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    one = dict(values(lm.score_texts(docs.coalesce(1)), "doc_id", "score"))
    other = docs.repartitionByRange(8, F.desc("text"))
    for doc_id, score in values(lm.score_texts(other), "doc_id", "score"):
        assert score == pytest.approx(one[doc_id], rel=2e-3)


def test_hidden_markov_deals_words_to_chunks_and_ranges(spark, monkeypatch, capsys):
    """The scores do not depend on how words are dealt; the sums come to chunks that are not shuffled."""
    docs = documents(spark).select("doc_id", "text")
    docs = docs.orderBy("doc_id").limit(60).withColumn("held_out", F.col("doc_id") % 5 == 0)
    odd = [(-1, "everywhere a", False), (-2, "held a b", True), (-3, "held twice twice", False)]
    docs = docs.unionAll(spark.createDataFrame(odd, docs.schema))
    texts = docs.collect()
    counts = Counter()
    for row in texts:
        if not row.held_out:
            counts.update(lm.tokens_of((row.text or "").encode()))
    words = {row.doc_id: lm.tokens_of((row.text or "").encode()) for row in texts}
    whole = dict(values(lm.score_texts(docs), "doc_id", "score"))
    monkeypatch.setattr(lm, "CHUNK", 300)
    monkeypatch.setattr(lm, "RANGE", 700)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lm.score_texts(docs)
        found.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    shuffled = re.search(r"Exchange hashpartitioning.*\n.*FileScan[^\n]*symbols", plan)
    assert "Bucketed: true" in plan and not shuffled
    for row in found.collect():
        assert row.n_known == sum(counts[w] > 0 for w in words[row.doc_id])
        assert row.train_tokens == sum(counts.values())
        assert row.score == pytest.approx(whole[row.doc_id], rel=2e-3)


def test_ranges_know_the_words_of_one_chunk(spark):
    """Of these, nothing needs to travel; words that others hold only in held-out texts do."""
    words = {1: [b"", b"own", b"both", b"shown"], 2: [b"", b"both", b"shown", b"unknown"]}
    counts = {1: [2, 3, 1, 4], 2: [1, 1, 0, 0]}
    pack = lambda x: lm.squeeze(np.array(x, "<i8").tobytes())
    rows = [(k, lm.squeeze(b" ".join(words[k])), pack(counts[k]), 4) for k in words]
    chunks = spark.createDataFrame(rows, "chunk long, words binary, counts binary, types long")
    found = lm._ranges(chunks).orderBy("range").collect()
    assert sum(r.tokens for r in found) == 12 and sum(r.types for r in found) == 4
    expected = {b"": (3, False), b"own": (3, True), b"both": (2, False), b"shown": (4, False)}
    expected[b"unknown"] = (0, True)
    for chunk in words:
        mine = [r for r in found if r.chunk == chunk]
        order, _ = lm._seeds(words[chunk])
        total = np.concatenate([np.frombuffer(lm.unsqueeze(r.totals), "<i8") for r in mine])
        alone = np.concatenate([np.frombuffer(lm.unsqueeze(r.alone), "?") for r in mine])
        for at, of_all, only in zip(order, total, alone):
            assert (of_all, only) == expected[words[chunk][at]]
        shared = [k for k in order if expected[words[chunk][k]][0] and not expected[words[chunk][k]][1]]
        own = np.concatenate([np.frombuffer(lm.unsqueeze(r.own), "<i4") for r in mine])
        assert own.tolist() == [counts[chunk][k] for k in shared]
    places = {(r.range, int(p)) for r in found for p in lm.unpacked(r.places)}
    assert len(places) == 3


def test_long_bridged_words_equal_a_plain_viterbi(spark):
    rng = np.random.default_rng(12)
    words = ["-" * 80, "antidisestablishmentarianismfloccinaucinihilipilification", "a" * 33]
    words += ["=" * 1000, "".join(rng.choice(list("etaoinshr"), 900)), "thе" + "ing" * 200]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    coded = pieces.encode_texts(docs, piece_model())
    back = {r.doc_id: r for r in pieces.decode_texts(coded, piece_model()).collect()}
    model = pieces._model(piece_model())
    known = {
        model.id_to_piece(i): (model.get_score(i), i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    longest, zero = max(map(len, known)), model.piece_to_id("<0x00>")
    for i, text in enumerate(words):
        word, best = "▁" + text, [(0.0, [])]
        for end in range(1, len(word) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                part, (points, codes) = word[start:end], best[start]
                if part in known:
                    ways.append((points + known[part][0], [*codes, known[part][1]]))
                elif len(part) == 1:
                    raw = part.encode()
                    ways.append((points - pieces.BYTE_COST * len(raw), [*codes, *[zero + b for b in raw]]))
            best.append(max(ways))
        assert back[i].codes == best[-1][1] and back[i].text == text


def test_parts_of_many_chunks_ranges_and_blocks(spark, monkeypatch, capsys):
    """The codes do not depend on how parts are dealt, and come to the chunks without a shuffle of these."""
    docs = odd_docs(spark).where("doc_id is null or doc_id not in (4, 10)")
    docs = docs.select("doc_id", "text").unionAll(documents(spark).select("doc_id", "text").limit(40))
    docs = docs.unionAll(spark.createDataFrame([(99, "a" * 90 + " 中文中文")], "doc_id long, text string"))
    whole = values(pieces.encode_texts(docs, piece_model()), "doc_id", "codes")
    assert len(whole) == docs.count()
    for name, value in (("CHUNK", 300), ("RANGE_TYPES", 40), ("BLOCK_PARTS", 8), ("TASK_PARTS", 500)):
        monkeypatch.setattr(pieces, name, value)
    found = pieces.encode_texts(docs, piece_model())
    assert values(found, "doc_id", "codes") == whole
    found.explain()
    plan = capsys.readouterr().out
    assert "Bucketed: true" in plan and not re.search(r"Exchange hashpartitioning.*\n.*numbers#", plan)
    assert pieces.encode_texts(docs.limit(0), piece_model()).count() == 0


def test_short_and_unspaced_texts_share_marks_with_their_edits(spark):
    texts = [
        "seven words are enough for a mark", "four words, two halves",
        "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨露结为霜", "x9" * 10 + "q7z" * 40,
        " ".join(f"word{i}" for i in range(18)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = winnowing.fingerprints_with_edits(docs).collect()
    assert len(found) == 5 and all(0 < row.near_edited < 1 for row in found if row.doc_id != 3)
    assert found and all(row.near_edited > row.near_next for row in found)
    spaced = spark.createDataFrame([(" a  text of\t\nwords ",), ("a text of words",)], "text string")
    assert len({tuple(r.marks) for r in winnowing.with_marks(spaced, "text", "marks").collect()}) == 1


def test_near_copies_and_shared_passages_stay(spark):
    nav = "<div>Home page news sport weather travel shop now</div>"
    own = ["".join(f"<p>{f'c{j}x ' * 3}{' '.join(f'v{j}w{w}' for w in range(20))}</p>" for j in range(12))]
    quote = " ".join(f"quoted{w}" for w in range(30))
    rows = [(i, f"http://h/{i}", f"{nav}<h2>The one title of all copies here</h2>{own[0]}<p>edit {i}</p>") for i in range(3)]
    rows += [
        (i, f"http://h/{i}", f"{nav}<p>{' '.join(f'b{i}w{w}' for w in range(40))}</p>" + (f"<p>{quote}</p>" if i < 5 else ""))
        for i in range(3, 9)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = dict(values(extract_text(frame), "page_id", "text"))
    for i in range(9):
        assert "Home page" not in got[i]
    for i in range(3):
        assert got[i].startswith("The one title") and len(got[i].split("\n\n")) == 14
    assert got[3].endswith(quote) and got[4].endswith(quote) and len(got[5].split()) == 40


def test_containers_named_like_chrome_keep_the_text(spark):
    prose = " ".join(f"word{i}" for i in range(20))
    article = f"<article><h1>T</h1><p>{prose}</p></article>"
    pages = [
        f"<html class='js cookies'><body class='has-sidebar'>{article}</body></html>",
        f"<body><article class='post comments-open'><h1>T</h1><p>{prose}</p></article></body>",
        f"<body><form id='f'>{article}</form></body>",
        f"<body><div class='with-sidebar'>{article}</div></body>",
        f"<body><main class='no-ads'><h1>T</h1><p>{prose}</p></main></body>",
        f"<body>{article}<section class='comments'><article class='comment'><p>{prose}</p></article></section></body>",
        f"<body><article class='has-sidebar'><h1>T</h1><p>{prose}</p></article></body>",
        f"<body><form><p>short</p><p>{prose}</p></form></body>",
    ]
    rows = [(i, f"http://h{i}/", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = dict(values(extract_text(frame), "page_id", "text"))
    assert [got[i] for i in range(7)] == [f"T\n\n{prose}"] * 7 and got[7] == prose


def test_labelled_sample_is_drawn_from_the_rows_at_hand(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, "t") for i in range(0, 3000, 60)], "doc_id long, text string")
    docs = docs.unionAll(spark.createDataFrame([(i, "t") for i in range(1, 1800, 60)], docs.schema))
    found, weights = labelled_sample(docs, labels, "toxic", 10, 5)
    held = {row.doc_id for row in docs.where(held_out(5)).collect()}
    n = [sum(row.doc_id % 2 == k and row.doc_id not in held for row in docs.collect()) for k in (0, 1)]
    assert min(n) > 10 and sorted(row.label for row in found.collect()) == [0] * 10 + [1] * 10
    assert weights == {0: n[0] / 10, 1: n[1] / 10}


def plain_winnowing(text):
    """Marks of a text, each window looked at by itself."""
    text = re.sub("[ \t-\r]+", " ", text).strip(" ")
    gram, window, low = winnowing.GRAM, winnowing.WINDOW, (1 << 31) - 1
    if not text:
        return []
    grams = [text[i : i + gram] for i in range(max(1, len(text) - gram + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) & 0xFFFFFFFF for g in grams]
    if len(hashes) < winnowing.FEW:
        return [h << 31 | low - i for i, h in enumerate(hashes)]
    marks = set()
    for start in range(len(hashes) - window + 1):
        least = min(hashes[start : start + window])
        marks.add(max(i for i in range(start, start + window) if hashes[i] == least))
    return [hashes[i] << 31 | low - i for i in sorted(marks)]


def test_marks_equal_a_plain_winnowing(spark):
    rng = np.random.default_rng(21)
    texts = [r.text for r in documents(spark).orderBy("doc_id").limit(60).collect()]
    # Cuts in white space, spaces at the seam, and lengths around every limit.
    texts += ["".join(rng.choice(list("ab \n\t中😀"), n)) for n in range(150)]
    texts += ["x" * 200, "ab " * 90, " " * 300, "word " * 30 + " " * 150, LONG[:20_000], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in winnowing.fingerprints_with_edits(docs).collect()}
    hashes = {}
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i].edited == edited
        assert found[i].marks == plain_winnowing(text)
        assert found[i].edited_marks == plain_winnowing(edited)
        hashes[i] = {m >> 31 for m in found[i].marks}
    for i in range(len(texts)):
        own, others = hashes[i], {m >> 31 for m in found[i].edited_marks}
        for other, got in ((others, found[i].near_edited), (hashes[(i - 1) % len(texts)], found[i].near_next)):
            either = len(own | other)
            assert got == pytest.approx(len(own & other) / either if either else 1.0)


def test_an_edit_hashes_only_what_is_across_the_seam(spark, monkeypatch):
    rng = np.random.default_rng(22)
    # Beginnings that keep just enough grams, with spaces at the seam and at the cut.
    texts = [rng.choice(["", " ", "\n "]) + "".join(rng.choice(list("abc \t中😀"), n)) for n in range(100, 260)]
    texts += ["y" * 400, "ab " * 150, "z" * 130, LONG[:3000]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashed, with_hashes = [], winnowing._with_hashes

    def noted(rows, text, at):
        hashed.append(rows.select(F.length(text).alias("n")))
        return with_hashes(rows, text, at)

    monkeypatch.setattr(winnowing, "_with_hashes", noted)
    found = {r.doc_id: r for r in winnowing.fingerprints_with_edits(docs).collect()}
    seam = 2 * (winnowing.GRAM + winnowing.WINDOW)
    for frame in hashed[1:]:
        # All but the texts whose parts are too short: a part of the next one's half.
        assert frame.where(F.col("n") > seam).count() < len(texts) / 2
        assert frame.agg(F.max("n")).first()[0] < 300
    for i, text in enumerate(texts):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[i - 1][:half]
        assert found[i].edited_marks == plain_winnowing(edited)
