"""corpus_pipeline.run against a plain version; filter forms told apart row by row; articles and tool calls against brute force."""

import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import SHAPE, WHITE, classes_of, corpus

import corpus_pipeline
from lexforge.llm import chat_format, exact_dedup, html_text, mixing, ngram_join, tokens, toxicity

SMALL = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_of_each_goes_by_rows(spark):
    a = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(a)), (2, " ".join(a + ["more"])), (2, "quite another text of some more words here"), (3, ""), (3, None), (4, "x y"), (4, "x y"), (None, "x y")]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, SMALL).coalesce(1))
    assert rows_of(got) == sorted([rows[0], rows[2], rows[3], rows[4], rows[7]], key=str)


def test_exact_dedup_goes_by_rows(spark):
    rows = [(0, "bbb longer text"), (1, "aaa"), (1, "bbblongertext"), (1, "aaa"), (2, None), (2, " ")]
    got = exact_dedup.deduplicate(spark.createDataFrame(rows, SMALL).coalesce(1))
    assert rows_of(got) == sorted([rows[0], rows[1], rows[5]], key=str)


def test_exact_dedup_state_outlives_the_run(spark, tmp_path):
    table = lambda rows: spark.createDataFrame(rows, SMALL).coalesce(1)
    state = f"file://{tmp_path}/state"
    one = exact_dedup.classes(table([(5, "a  b"), (6, "c")]), state=state).collect()
    two = exact_dedup.classes(table([(1, "ab"), (2, "c"), (3, "new")]), state=state).collect()
    assert sorted((r.doc_id, r.kept) for r in one) == [(5, True), (6, True)]
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in two) == [(1, 5, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_mixed_goes_by_rows(spark):
    rows = [(i % 7, f"t{i} " * (1 + i % 5), "s" if i % 3 else None, i) for i in range(60)] + [(1, "t1 t1 ", "s", 99)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    want = mixing.mix(docs).agg(F.sum("taken"), F.sum("copies")).first()
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.count() == want[1]
    assert sum(len(WORD.findall(r.text)) for r in got.collect()) == want[0]
    assert set(map(tuple, got.collect())) <= set(rows)


def plain_score(model, text):
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    place, out = 0, []
    on = []
    for kind, known in zip(toxicity.BEGINNINGS, model.features):
        own = words if not kind else {w[:kind] for w in words if len(w) > kind}
        on += [place + i for i, f in enumerate(known.to_pylist()) if f in own]
        place += len(known)
    for k, _ in enumerate(model.categories):
        z = model.bias[k] + sum(model.weights[i, k] for i in on) + sum(a * p for a, p in zip(model.earlier[k], out))
        out.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
    return out[-1]


def plain_mix(rows):
    """rows: (doc_id, text, source, ...). Each row as often as it is taken."""
    size = lambda r: len(WORD.findall(r[1] or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r) for r in rows if r[3] == s) for s in sources}
    weight, out, left, free = {s: i % 3 + 1 for i, s in enumerate(sources)}, [], sum(total.values()), set(sources)
    target = {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * total[s]]
        target |= {s: 3.0 * total[s] for s in over} if over else {s: level * weight[s] for s in free}
        left -= sum(3 * total[s] for s in over)
        free -= set(over or free)
    for s in sources:
        rate = target[s] / total[s] if total[s] else 0.0
        start = int(hashlib.md5(f"{mixing.SEED}:{'s' + s if s is not None else 'n'}".encode()).hexdigest()[:8], 16) / 2**32
        for place, r in enumerate(sorted((r for r in rows if r[3] == s), key=lambda r: (size(r), r[0])), 1):
            out += [r] * min(3, math.floor(place * rate + start) - math.floor((place - 1) * rate + start))
    return out


def test_pipeline_against_a_plain_version(spark, tmp_path):
    rng = random.Random(11)
    rows = [r for r in corpus(seed=9, n=45) if len(r[1] or "") < 20_000]
    rows = [(r[0], (r[1] or "") + " scumbag loser morons", *r[2:]) if r[1] and r[0] % 8 == 3 else r for r in rows]
    labels = [(r[0], rng.randint(0, 1), int("scumbag" in (r[1] or ""))) for r in rows if r[0] % 2 or r[0] % 8 == 3]
    docs = spark.createDataFrame(rows, SHAPE)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = f"file://{tmp_path}"
    got = corpus_pipeline.run(spark, sf).collect()

    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = [r for r in rows if plain_score(model, r[1]) < toxicity.THRESHOLD]
    assert 0 < len(kept) < len(rows)
    best = {}
    for r in kept:
        key = WHITE.sub("", r[1] or "")
        best[key] = min(best.get(key, r), r, key=lambda x: (-len(x[1] or ""), x[0]))
    kept = list(best.values())
    component = {i: least for i, _, least in classes_of(kept)}
    kept = [r for r in kept if component[r[0]] == r[0]]
    encoder, want = tokens.Encoder(tokens.vocabulary_path()), []
    for r in plain_mix(kept):
        ids = [*encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want += [(r[0], p, len(ids[p * 4096 : p * 4096 + 4096]), zlib.crc32(np.array(ids[p * 4096 : p * 4096 + 4096], "<u4").tobytes())) for p in range(-(-len(ids) // 4096))]
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == sorted(want)
    used = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_generated_articles(seed):
    """Articles of headings, paragraphs and lists with telling ids and classes, among all kinds of other things."""
    rng = random.Random(seed)
    words = lambda n: " ".join(rng.choice(["some", "words", "of", "an", "article", "that", "goes", "on"]) for _ in range(n))
    others = ["<nav><a href=/>Home page</a></nav>", "<div class='site-footer'><p>foot words</p></div>", "<div class=ad>Buy this now</div>", "<div id=cookie-notice><p>We use cookies</p></div>", "<aside><p>aside</p></aside>", "<form><p>Sign up</p><input></form>", "<script>var a = '<p>x</p>';</script>", "<div class='sidebar-left'><ul><li><a href=x>link</a></ul></div>", f"<section id=comments><p>{'a reader wrote this ' * 3}</p></section>"]
    for holder in ("<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id='no-ads'>{}</div>"):
        blocks, html = [], ""
        for k in range(rng.randint(8, 20)):
            text, tag = words(rng.choice([2, 30, 60])), rng.choice(["p", "p", "p", "h2", "blockquote"])
            blocks.append(text)
            html += f"<{tag}{rng.choice(['', ' id=search', ' id=related-work', ' class=ad-hoc', ' id=share-this'])}>{text.replace(' ', '  ')}</{tag}>\n"
            if k and rng.random() < 0.2:
                html += rng.choice(others)
        page = "<html><head><title>t</title></head><body>" + "".join(rng.sample(others, 4)) + holder.format(html) + "".join(rng.sample(others, 3)) + "</body></html>"
        assert html_text.main_text(page) == "\n\n".join(blocks)


def test_very_deep_pages_end():
    assert html_text.main_text("<div>x" * 30_000).count("x") == 30_000
    assert html_text.main_text("<div class=ad><p>" * 20_000 + "x") is not None


def test_html_of_nothing(spark):
    assert html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_calls_against_brute_force(spark):
    rng, rows = random.Random(2), []
    for conv in range(12):
        ids = [f"c{i}" for i in range(6)]
        for turn in range(10):
            kind = rng.random()
            if kind < 0.4:
                n = rng.randint(0, 3)
                calls = [{"name": rng.choice(["search", "weather", "odd"]), "id": rng.choice(ids), "arguments": rng.choice([{"query": "q"}, {"city": "x", "days": 2}, {"days": 1}])} for _ in range(n)]
                rows.append((conv, rng.choice([turn, 3]), "assistant", f"say {rng.random()} " + "".join(f"<tool_call>{json.dumps(c)}</tool_call>" for c in calls), turn))
            elif kind < 0.8:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": rng.choice(ids), "content": turn}), turn))
            else:
                rows.append((conv, turn, "user", None if kind < 0.85 else "hi", turn))
    rows += [rows[0], (None, 1, "assistant", '<tool_call>{"name":"search","id":"c0","arguments":{"query":"z"}}</tool_call>', 1), (0, 1, "user", "long " * 50_000, 1)]
    got = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_calls int").repartition(3)).collect()
    calls = {}
    for conv, turn, role, text, _ in rows:
        if role == "assistant":
            for place, c in enumerate(json.loads(x) for x in re.findall(r"<tool_call>(.*?)</tool_call>", text)):
                calls.setdefault((conv, c["id"]), []).append((turn, place, c["name"]))
    fits = lambda c: c["name"] == "search" and set(c["arguments"]) == {"query"} or c["name"] == "weather" and "city" in c["arguments"]
    want = []
    for conv, turn, role, text, _ in rows:
        own = [json.loads(x) for x in re.findall(r"<tool_call>(.*?)</tool_call>", text or "")] if role == "assistant" else []
        first = min(calls.get((conv, json.loads(text)["tool_call_id"]), [None])) if role == "tool" else None
        link = "linked" if first else "orphan" if role == "tool" else "calls" if own else "none"
        want.append((conv, turn, role, link, len(own), sum(map(fits, own)), *((max(turn, first[0]), int(first[0] >= turn), first[1]) if first else (turn, 0, -1))))
    assert sorted(((r.conv_id, r.turn, r.role, r.link, r.n_calls, r.n_valid, r.order_turn, r.order_step, r.order_call) for r in got), key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.formatted(empty).count() == 0
