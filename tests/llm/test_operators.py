"""Every corpus operator against brute force on small tables with nulls, empties, ties, repeats, long texts and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.llm import chat_format, exact_dedup, html_text, line_dedup, mixing, near_dedup, ngram_join, packing, tokens, toxicity, url_filter

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, row string"
WHITE = re.compile(r"[\x20\x09-\x0D]")


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "an", "Ed", "ble", "é", "ß"]) for _ in range(rng.randint(1, 3)))
    out, base = [], [[word() for _ in range(rng.randint(30, 120))] for _ in range(8)]
    passage = " ".join(word() for _ in range(60))
    for i in range(n):
        b = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            b[rng.randrange(len(b))] = word()
        out.append("\n".join(" ".join(b[k : k + 12]) for k in range(0, len(b), 12)) + (f"\n{passage}" if i % 5 == 0 else ""))
    out += [None, "", " \n\t", "one two", "One  two", "a b c d e", "same text here", "same  text here ", "long " * 9000 + "end"]
    rows = [(i, t, "en", None if i % 9 == 0 else f"s{i % 4}", 0, 1, True, "r") for i, t in enumerate(out)]
    return [*rows, rows[1], rows[1]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SHAPE).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def test_exact_dedup(docs, none):
    rows = corpus()
    norm = lambda t: WHITE.sub("", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append((-len(r[1] or ""), r[0]))
    want = sorted((r[0], min(groups[norm(r[1])])[1], len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    for digest in (exact_dedup.sha256, lambda b: bytes([zlib.crc32(b) % 5])):  # the second one collides: bytes decide
        got = exact_dedup.classes(docs, digest).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.deduplicate(docs).count() == len(groups)
    assert exact_dedup.classes(none).count() == 0


def classes_of(rows, percent=75):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or ""))
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in w]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    least = {}
    for r, x in zip(rows, label):
        least[x] = min(least.get(x, r[0]), r[0])
    return sorted((r[0], len(s), least[x]) for r, s, x in zip(rows, sets, label))


@pytest.mark.parametrize("unit", [1024, 5])
def test_ngram_join(docs, none, unit):
    got = ngram_join.jaccard_classes(docs, unit=unit).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == classes_of(corpus())
    if unit == 5:
        assert ngram_join.jaccard_classes(none).count() == 0


def test_shingles_of_slices():
    text = pa.array([r[1] for r in corpus()])
    whole = ngram_join.shingle_sets(text)
    assert all(np.array_equal(whole[i], ngram_join.shingle_sets(text.slice(i, 1))[0]) for i in range(len(text)))


def test_signature_tree_finds_all_components():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(20)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) < 0.93], rng.integers(0, 2**63, 8).astype(np.uint64)])) for b in base for _ in range(5)]
    t = ngram_join.Threshold()
    label = np.arange(len(sets))
    for x, y in ngram_join.exact_links(sets, label.copy(), t):
        label[label == label[y]] = label[x]
    may = ngram_join.possible_links([len(s) for s in sets], [ngram_join.bitmap(s) for s in sets], np.arange(len(sets)), t)
    for i in range(len(sets)):
        for j in range(i):
            if t.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                assert label[i] == label[j]
                assert {(i, j), (j, i)} & may


def test_packing_round_trip(docs, none):
    rows, encoder = corpus(), tokens.Encoder(tokens.vocabulary_path())
    want = []
    for r in rows:
        ids = [*encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want += [(r[0], p, len(ids[p * 256 : p * 256 + 256]), zlib.crc32(np.array(ids[p * 256 : p * 256 + 256], "<u4").tobytes())) for p in range(-(-len(ids) // 256))]
    got = packing.pack(docs, capacity=256, fan_in=2, slack=1).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    whole = packing.best_fit(np.array([w[2] for w in want]), 256)[2]  # all pieces in one task
    assert len(by) <= 1.05 * whole + 1
    assert packing.pack(none).count() == 0


def test_line_dedup(docs, none, spark):
    rows = corpus()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(r[0])
    want = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == r[0]]
        want.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = line_dedup.deduplicated(docs).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == sorted(want)
    assert line_dedup.deduplicated(none).count() == 0


def test_line_shards_grow_with_the_postings(docs, spark, monkeypatch):
    """More shards than shuffle partitions give the same rows."""
    want = sorted(map(tuple, line_dedup.deduplicated(docs).collect()))
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    assert line_dedup.shards_for(spark, 1000) == 63 and sorted(map(tuple, line_dedup.deduplicated(docs).collect())) == want


def test_line_index_is_reversible(docs, spark):
    p = line_dedup.postings(docs.dropDuplicates(["doc_id"])).where("k1 IS NOT NULL").cache()
    rows = lambda i: sorted(map(tuple, i.refs.select("k1", "k2", "refs", "least", "most").collect()))
    one = line_dedup.LineIndex(spark, 4).insert(p.where("doc_id < 30"))
    both = one.insert(p.where("doc_id >= 30"))
    assert rows(both) == rows(line_dedup.LineIndex(spark, 4).insert(p))
    back = both.delete(p.where("doc_id >= 30").select("doc_id"))
    assert rows(back) == rows(one)


def test_cuckoo_filter():
    keys = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    stack = line_dedup.add_to_stack([], keys)
    has = lambda k: np.any([f.contains(k) for f in stack], axis=0)
    assert has(keys).all()
    other = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 5000)
    assert has(other).mean() < 0.01
    assert stack[0].remove(keys[:2500]).sum() == 2500 and has(keys[2500:]).all() and has(keys[:2500]).mean() < 0.02


def test_mixing(docs, none):
    rows = [(r.doc_id, r.source, r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(docs).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r[0], r[2]) for r in rows) == sorted((r[0], size(r[1])) for r in corpus())
    total, sums = {}, {}
    for _, s, n, *_ in rows:
        total[s] = total.get(s, 0) + n
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, left, free = {}, sum(total.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * total[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * total[s]
            left -= want[s]
            free.discard(s)
    want |= {s: level * weight[s] for s in free}
    for _, s, n, source_size, target, taken in rows:
        assert source_size == total[s] and target == pytest.approx(want[s]) and taken <= 3 * n
        sums[s] = sums.get(s, 0) + taken
    for s in names:
        assert abs(sums[s] - want[s]) <= max(n for _, x, n, *_ in rows if x == s) * 1.5 + 1
    assert sorted(rows, key=str) == sorted(((r.doc_id, r.source, r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(docs.repartition(5)).collect()), key=str)
    assert mixing.mix(none).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(5)
    plain, bad = [f"w{i}x" for i in range(400)], ["loser", "scumbag", "morons"]
    make = lambda t: " ".join(rng.choices(plain, k=40) + (rng.choices(bad, k=2) if t else []))
    toxic = [i % 6 == 0 for i in range(600)]
    rows = [(i, make(t), "x") for i, t in enumerate(toxic)] + [(600, None, "x"), (601, "", "x"), (602, "you LOSER! scumbags", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, 1, int(toxic[i])) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.scores(docs, toxicity.fit(docs, labels)).collect()}
    assert sum(got[i] == toxic[i] for i in range(400, 600)) >= 198 and not got[600] and not got[601] and got[602]
    model = toxicity.fit(docs, labels)
    kept = toxicity.filter_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not x for x in got.values())
    assert not any(r.toxic for r in toxicity.scores(docs, toxicity.fit(docs, labels.limit(0))).collect())


PAGE = "<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></ul></nav><div class='ad'>Buy</div>{}<footer>&copy; x</footer></body>"


def test_html():
    body = "<h1>Head &amp; tail</h1><p><b>Some  text.<br><p>Short.<p>" + "Long paragraph of words. " * 9 + "</p><script>var a='</p>'</script><aside>Side</aside>"
    want = "Head & tail\n\nSome text.\n\nShort.\n\n" + " ".join(["Long paragraph of words."] * 9)
    assert html_text.main_text(PAGE.format(f"<article>{body}</article><section id=comments><p>A comment</p></section>")) == want
    assert html_text.main_text(PAGE.format(f"<div id=content>{body}</div>")) == want
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<p>a<![bad <p>b") is not None
    assert html_text.main_text("<p>tea &#x26; milk <span class=promo>now</span> only") == "tea & milk only"


def test_html_wrappers_with_the_article():
    text = "\n\n".join(["Long paragraph of words."] * 6)
    body = "".join(f"<p>{x}</p>" for x in text.split("\n\n"))
    for wrapper in ("<div class='content-sidebar-wrap'>{}</div>", "<div class='has-sidebar'><div id=no-ads>{}</div></div>", "<form>{}</form>"):
        side = "<div class=sidebar><p>Side</p></div>"
        assert html_text.main_text(PAGE.format(wrapper.format(f"<article>{body}</article>{side}"))) == text
        assert html_text.main_text(PAGE.format(wrapper.format(f"<div id=content>{body}</div>{side}"))) == text
    assert html_text.main_text(PAGE.format(f"<div>{body}</div><div class=comments><article>{body * 9}</article></div>")) == text


def test_html_goes_on_after_what_cannot_be_parsed():
    got = [b.text for b in html_text.blocks_of("<p>first part</p><p>second<![bad <p>third</p>")[0]]
    assert got == ["first part", "second![bad", "third"]


def test_html_table(spark):
    rows = [(1, "http://a", PAGE.format("<article><p>x y</p></article>"), "t", 1), (2, None, None, "t", 2), (1, "http://a", "", "t", 3)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (1, "x y", 3), (2, "", 0)]


def test_near_dedup(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((12, 16))
    x = [c + rng.standard_normal(16) * s for c in centre for s in (0.0, 0.0, 0.05, 0.1, 0.15, 0.2, 0.3) for _ in range(6)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, []), (n + 4, [None] + [1.0] * 15), (n + 5, [1.0, 2.0])]
    got = {r.vec_id: r for r in near_dedup.near_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    found = sum(got[i].n_links for i in range(n))
    assert 0.98 * (link.sum() - n) <= found <= link.sum() - n
    assert all(got[i].n_links <= link[i].sum() - 1 for i in range(n))
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(n, n + 6))
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert near_dedup.near_links(empty).count() == 0


def test_near_audit_counts_vectors(spark):
    """A hot group's links, all found, do not hide that every other pair was missed."""
    rng = np.random.default_rng(6)
    pairs = np.repeat(rng.standard_normal((40, 32)), 2, axis=0)
    x = np.concatenate([np.repeat(rng.standard_normal((1, 32)), 400, axis=0), pairs + 0.05 * rng.standard_normal(pairs.shape)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist(), 399 if i < 400 else 0, i, 399 if i < 400 else 0, i == 0 or i >= 400) for i, v in enumerate(x)]
    result = spark.createDataFrame(rows, "id long, x array<double>, n_links long, component_id long, own long, lead boolean")
    assert near_dedup.audit(result.select("id", "x"), result, 0.9) < 0.1
    found = result.withColumn("n_links", F.when(F.col("id") < 400, 399).otherwise(1).cast("long"))
    assert near_dedup.audit(result.select("id", "x"), found, 0.9) == 1.0


@pytest.fixture(scope="module")
def diffuse(spark):
    """One wide group, too far apart for balls, with copies, beside ordinary pairs."""
    rng = np.random.default_rng(8)
    wide = rng.standard_normal(24) * 1.5 + rng.standard_normal((300, 24)) * 0.45
    pairs = np.repeat(rng.standard_normal((20, 24)), 2, axis=0)
    x = np.concatenate([wide, wide[:30], pairs + 0.1 * rng.standard_normal(pairs.shape)])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), u @ u.T >= 0.9


def test_near_dedup_saturated_lists_are_compared_exactly(diffuse, monkeypatch):
    monkeypatch.setattr(near_dedup, "WIDEST", 16)
    monkeypatch.setattr(near_dedup, "BLOCK", 128)
    df, link = diffuse
    got = {r.vec_id: r for r in near_dedup.near_links(df, size=4).collect()}
    assert link.sum(1).max() > 100 and [got[i].n_links for i in range(len(link))] == (link.sum(1) - 1).tolist()
    label = np.arange(len(link))
    for i, j in zip(*np.nonzero(link)):
        label[label == label[j]] = label[i]
    assert all(got[i].component_id == np.flatnonzero(label == label[i])[0] for i in range(len(link)))


def test_near_dedup_fails_below_the_target(diffuse, monkeypatch):
    monkeypatch.setattr(near_dedup, "MOST_TREES", 4)
    with pytest.raises(RuntimeError):
        near_dedup.near_links(diffuse[0].limit(40), target=1.1)


def test_url_filter(spark):
    urls = ["http://a.NET/x", "https://www.example.net/en/1?a=1", "http://example.com/de/2", "http://x.org/fr/", "http://net/", "http://net", "http://b.example.com/en/9", "nothing", None, "http://xexample.net/en/1", ""]
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")).collect()}
    assert [got[i].rule for i in range(len(urls))] == ["net/", "example.net/en/", "example.com/de/", "org/fr/", "net/", None, None, None, None, "net/", None]
    assert [(got[i].host, got[i].path) for i in (0, 1, 5, 7, 8)] == [("a.net", "/x"), ("www.example.net", "/en/1"), ("net", ""), ("", ""), ("", "")]
    assert all(r.verdict in ("allow", "block") for r in got.values()) and got[1].verdict == "allow" and got[2].verdict == "block"


def test_url_filter_with_a_hot_url(spark):
    """A hot page with many query strings, repeated rows and a wide spread of domains: both classes fit, all count."""
    urls = [f"http://hot.net/p?q={i % 150}" for i in range(3000)] + [f"http://d{i}.org/fr/{i}" for i in range(300)] + ["http://hot.net/p"] * 50 + ["http://d7.org/other"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for top in (10, 40):
        got = url_filter.judged(pages, max_train_rows=top).collect()
        assert all((r.block_prob is None) == (r.rule is not None) for r in got) and sum(r.block_prob is not None for r in got) == 1
    rows = url_filter.lexical(pages).withColumn("blocked", F.when(F.col("host") == "hot.net", 1).when(F.col("path").startswith("/fr"), 0))
    label, domain = url_filter.train(rows, 10, 2, 2)[1:3]
    assert {r.label: round(r.f_label, 6) for r in label.collect()} == {"net": round(3051 / 3052, 6), "org": round(1 / 302, 6)}
    assert domain.count() == 301


def labelled_urls(n, seed):
    """Urls whose label shows in their form only: blocked ones have long paths with digits and several parameters."""
    rng = random.Random(seed)
    pick = lambda chars, a, b: "".join(rng.choice(chars) for _ in range(rng.randint(a, b)))
    out = []
    for i in range(n):
        blocked = rng.random() < 0.4
        path = "/".join(pick("0123456789abcdef", 8, 14) if blocked else pick("aeioulmnrst", 3, 8) for _ in range(rng.randint(1, 4)))
        query = "?" + "&".join(f"{pick('abc', 1, 2)}={pick('0123456789', 2, 6)}" for _ in range(rng.randint(1, 4))) if rng.random() < (0.8 if blocked else 0.2) else ""
        out.append((i, f"http://{pick('bcdfgaeiou', 4, 9)}.{rng.choice(['com', 'org', 'net'])}/{path}{query}", int(blocked)))
    return out


def test_url_trees_on_held_out_urls(spark):
    """Trees from labelled urls judge other urls of other hosts; shares out of fold leave out the row's own label."""
    rows = url_filter.lexical(spark.createDataFrame(labelled_urls(3000, 5), "page_id long, url string, blocked int"))
    model, label, domain, _ = url_filter.train(rows, 2000, 8, 3)
    other = url_filter.lexical(spark.createDataFrame(labelled_urls(1500, 6), "page_id long, url string, truth int"))
    got = url_filter.predicted(other, model, label, domain).select("truth", "prediction").collect()
    assert np.mean([r.truth == r.prediction for r in got]) > 0.93
    alone = url_filter.with_statistics(rows, label, domain, out_of_fold=True)
    assert alone.join(rows.groupBy("domain").count().where("count = 1"), "domain").where("f_domain <> f_label").isEmpty()


def test_url_filter_edges(spark):
    """An empty table, repeated rows, a very long url, clashing columns."""
    shape = "page_id long, url string, host string, blocked int, label string"
    assert url_filter.judged(spark.createDataFrame([], shape)).count() == 0
    long = "http://a.org/fr/" + "x1/" * 40000
    rows = [(1, "http://b.net/p", "h", 1, "l"), (1, "http://b.net/p", "h", 1, "l"), (2, long, "h", 0, "l"), (3, long.replace("/fr/", "/de/"), None, None, None)]
    got = sorted((r.page_id, r.host, len(r.path), r.rule, r.verdict) for r in url_filter.judged(spark.createDataFrame(rows, shape)).collect() if r.rule)
    assert got == [(1, "b.net", 2, "net/", "block"), (1, "b.net", 2, "net/", "block"), (2, "a.org", len(long) - 12, "org/fr/", "allow")]


def test_chat(spark):
    call = '<tool_call>{"name": "search", "id": "c1", "arguments": {"query": "q", "limit": 2}}</tool_call>'
    bad = '<tool_call>{"name": "search", "id": "c2", "arguments": {"limit": "two"}}</tool_call><tool_call>{oops</tool_call>'
    rows = [
        (1, 0, "user", "hi"), (1, 1, "tool", '{"content": {"b": 1, "a": [1, 2]}, "tool_call_id": "c1"}'), (1, 2, "assistant", "let me " + call), (1, 3, "assistant", bad),
        (1, 4, "tool", '{"tool_call_id": "zz", "content": "x"}'), (2, 0, None, None), (None, 0, "user", 'q"\n'),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in chat_format.formatted(df).collect()}
    assert got[1, 1].message == '{"content":{"a":[1,2],"b":1},"role":"tool","tool":"search","tool_call_id":"c1"}'
    assert (got[1, 1].order_turn, got[1, 1].order_step, got[1, 1].link) == (2, 1, "linked")
    assert got[1, 2].message == '{"content":"let me","role":"assistant","tool_calls":[{"arguments":{"limit":2,"query":"q"},"id":"c1","name":"search","valid":true}]}'
    assert (got[1, 3].n_calls, got[1, 3].n_valid, got[1, 3].n_open, got[1, 3].n_malformed, got[1, 4].link) == (2, 0, 2, 1, "orphan")
    assert got[2, 0].message == '{"content":"","role":""}' and got[None, 0].message == '{"content":"q\\"\\n","role":"user"}'
    chat = {r.conv_id: r.chat for r in chat_format.conversations(df).collect()}
    assert chat[1].index("let me") < chat[1].index('"tool_call_id":"c1"')
