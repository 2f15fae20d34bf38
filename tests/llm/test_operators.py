"""Every operator against a plain version, on awkward rows and on a whole small table."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevault.llm import decontaminate, html_text, language, lm_score, near_dedup, pack, quality_model, quality_rules, shard, substrings
from lakevault.session import scratch_path
from lakevault.llm.tokens import END_ID, tokenizer_path
from tests.llm.helpers import SF, awkward, crc, empty, hits, measured, near_groups, shingles, without_repeats, words


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('odd')}/docs"
    awkward(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(f"{tokenizer_path()}.json")


def plain_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")


# ------------------------------------------------------------------ 1 quality classifier
def test_quality_learns_what_the_labels_mark(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_model.op1_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9


def test_quality_of_awkward_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 1), (9, 0), (12, 0), (None, 1), (10, None), (3, 7)], "doc_id long, quality int")
    rows = quality_model.op1_quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    unlabelled = quality_model.op1_quality(odd, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert quality_model.op1_quality(empty(spark), labels).count() == 0


def test_trees_are_stepped_through_as_written():
    dice = np.random.default_rng(1)
    x = dice.normal(size=(500, len(quality_model.FEATURES)))
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0)).astype(float)
    forest = quality_model.fit_forest(x, y, trees=15)
    assert np.mean((forest.score(x) > 0.5) == y) > 0.95
    for i in (0, 7, 99):
        total = forest.base
        for t in range(15):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + (2 if x[i, forest.feature[t, node]] > forest.threshold[t, node] else 1)
            total += forest.leaf[t, node - forest.feature.shape[1]]
        assert math.isclose(total, forest.raw(x[i : i + 1])[0], rel_tol=1e-12)


# ------------------------------------------------------------------ 2 language-model score
def plain_base(rows, mod=5):
    tokens = [[*words((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))), None] for _, t in rows]
    count = Counter()
    for (d, _), tok in zip(rows, tokens, strict=True):
        if d is not None and crc(d) % mod != 1:
            count.update(tok)
    n, v = sum(count.values()), len(count)
    return n, [(len(t), sum(count[w] > 0 for w in t), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for t in tokens]


@pytest.mark.parametrize("which", ["table", "awkward"])
def test_lm_base_score_is_the_unigram(spark, odd, which):
    docs = documents(spark) if which == "table" else odd
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    n, want = plain_base(rows)
    got = lm_score.op2_scores(docs).collect()
    assert len(got) == len(rows)
    key = lambda t: (-1 if t[0] is None else t[0], t[1], t[2], round(t[3], 6))
    a = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    b = sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=key)
    for x, y in zip(a, b, strict=True):
        assert x[:3] == y[:3] and math.isclose(x[3], y[3], rel_tol=1e-9)
    assert {r.train_tokens for r in got} == {n}
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    if which == "table":
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_without_rows_to_learn_from(spark):
    one = spark.createDataFrame([(5, "a b"), (6, None)], "doc_id long, text string")
    rows = lm_score.score_texts(one, trainable=F.lit(False)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(3, 0, 0), (1, 0, 0)}
    assert lm_score.op2_scores(empty(spark)).count() == 0


def test_attention_scores_each_token_once_and_sums_to_one():
    from lakevault.llm import attention as A

    dice = np.random.default_rng(3)
    counts = dice.integers(0, 50, 300).astype(float)
    classes = A.make_classes(counts, 299, np.arange(300))
    flat = A.fresh(classes.prior) + dice.normal(0, 0.1, len(A.fresh(classes.prior))).astype(np.float32)
    scorer = A.Scorer(flat, classes, batch=7)
    ids = dice.integers(0, 300, 100)
    whole = scorer.log10(ids, np.array([100]), 299)
    # by overlapping windows of one sequence, the same as alone, together with others, or with another future
    both = scorer.log10(np.concatenate([ids[:5], ids, ids[:40]]), np.array([5, 100, 40]), 299)
    assert np.allclose(both[5:105], whole, atol=1e-4)
    assert np.allclose(both[105:], whole[:40], atol=1e-4) and np.allclose(both[:5], whole[:5], atol=1e-4)
    # a distribution over all ids at a place
    every = np.array([scorer.log10(np.append(ids[:50], i), np.array([51]), 299)[-1] for i in range(300)])
    assert math.isclose((10**every).sum(), 1, rel_tol=1e-3)


def test_attention_gradient():
    from lakevault.llm import attention as A

    dice = np.random.default_rng(5)
    flat = dice.normal(0, 0.3, len(A.fresh(np.zeros(A.CLASSES)))).astype(np.float64)
    c, y = dice.integers(0, A.CLASSES, (2, 3, A.CONTEXT))
    valid = dice.random((3, A.CONTEXT)) > 0.2

    def loss(w):
        w = A.unflatten(w)
        x = w["embed"][c] + w["place"]
        s = np.exp((x @ w["query"]) @ (x @ w["key"]).transpose(0, 2, 1) / np.sqrt(A.WIDTH)) * A.CAUSAL
        h = x + (s / s.sum(-1, keepdims=True)) @ (x @ w["value"]) @ w["mix"]
        z = h @ w["out"] + w["pair"][c] + w["bias"]
        p = z - np.log(np.exp(z).sum(-1, keepdims=True))
        return -(np.take_along_axis(p, y[:, :, None], 2)[:, :, 0] * valid).sum() / valid.sum()

    g = A._gradient(A.unflatten(flat), c, y, valid)
    for k in dice.integers(0, len(flat), 60):
        step = np.zeros(len(flat))
        step[k] = 1e-4
        assert math.isclose((loss(flat + step) - loss(flat - step)) / 2e-4, g[k], abs_tol=2e-4)


# ------------------------------------------------------------------ 3 packing
@pytest.mark.parametrize("which", ["table", "awkward"])
def test_packing_places_every_id_once(spark, odd, tokenizer, which):
    docs = documents(spark) if which == "table" else odd
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(r.text)
    pieces = pack.pack_documents(docs, with_ids=True, flush_tokens=5000).collect()
    total = 0
    by_doc = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_doc[p.doc_id].append(p)
    for doc, own in by_doc.items():
        want = Counter()
        for text in texts[doc]:
            ids = plain_ids(tokenizer, text)
            total += len(ids)
            want.update((int(i), k, len(ids)) for k, i in enumerate(ids))
        assert want == Counter((i, p.start + k, p.doc_tokens) for p in own for k, i in enumerate(p.ids))
    assert set(by_doc) == set(texts)
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    waste = 0
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at <= own[0].context <= 1024 and len({(p.context, p.step_group) for p in own}) == 1
        waste += 0 if at & (at - 1) == 0 else 1024 - at
    assert waste <= 1024 * docs.rdd.getNumPartitions()
    steps = defaultdict(set)
    for p in pieces:
        steps[p.step_group].add((p.context, p.sequence_id))
    assert all(len({c for c, _ in s}) == 1 and sum(c for c, _ in s) <= 65536 for s in steps.values())


def test_packing_nothing(spark):
    assert pack.op3_packing(empty(spark)).count() == 0


# ------------------------------------------------------------------ 4 near duplicates
def variants(n: int, changes: int, length: int = 300) -> list[str]:
    dice = np.random.default_rng(2)
    base = [f"t{i}" for i in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in dice.integers(0, length, changes):
            w[k] = f"v{dice.integers(1 << 30)}"
        out.append(" ".join(w))
    return out


def test_near_groups_of_chains_and_copies(spark):
    chain, w = [], [f"c{i}" for i in range(200)]
    for step in range(12):  # neighbours are alike, the ends are not
        w = [f"s{step}" if k in (15 * step, 15 * step + 1) else x for k, x in enumerate(w)]
        chain.append(" ".join(w))
    texts = variants(40, 4) + chain + ["x y z"] * 5 + ["X y Z", "x y", "", " ", "a b c d e f g", "a b c d e f g h"] + variants(6, 14)
    dice = np.random.default_rng(4)
    rows = dict(zip(dice.permutation(1000)[: len(texts)].tolist(), texts, strict=True))
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    want = near_groups(rows)
    for r in near_dedup.op4_near_dedup(docs).collect():
        assert r.n_shingles == len(shingles(rows[r.doc_id]))
        assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_a_block_asks_once_about_each_shingle(spark, monkeypatch):
    line = " ".join(f"b{k}" for k in range(12))
    texts = [f"{line} {' '.join(f'u{i}x{k}' for k in range(6))}" + (" p q r s t" if i in (4, 7) else "") for i in range(60)]
    component = [7 if i in (4, 7) else i // 2 for i in range(60)]
    pack = near_dedup.zstandard.ZstdCompressor().compress
    rows = [(i, component[i], bytearray(pack(t.encode()))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "row long, c long, text binary").coalesce(1)
    asked = []
    exchange = near_dedup.exchange
    monkeypatch.setattr(near_dedup, "exchange", lambda messages, answer: asked.append(messages) or exchange(messages, answer))
    got = {r.row: r.common for r in near_dedup._common(df).collect()}
    held = defaultdict(set)
    for i, t in enumerate(texts):
        for s in shingles(t):
            held[s].add(component[i])
    assert got == {i: sum(len(held[s]) > 1 for s in shingles(t)) for i, t in enumerate(texts)}
    assert sum(len(near_dedup.expand(r.data)[0]) for r in asked[0].collect()) == len(held)  # one block


def test_near_dedup_of_awkward_rows(spark, odd):
    kept = near_dedup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    sets = [s for s in map(shingles, texts) if s]
    assert len(sets) == len(set(sets))
    assert Counter(not shingles(t) for t in texts)[True] == sum(not shingles(r.text) for r in odd.collect())
    rows = near_dedup.op4_near_dedup(odd).collect()
    assert len(rows) == odd.count()
    assert near_dedup.op4_near_dedup(empty(spark)).count() == 0
    assert near_dedup.keep_one_of_each(empty(spark)).count() == 0


# ------------------------------------------------------------------ 5 html
@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p> a &lt;b&amp;c&#233; \n d</p><p>e<br>f", "a <b&cé d\ne f"),
        ("<nav>m</nav><article><h1>T</h1><p>one <b>two</b></p><aside>s</aside></article><footer>f</footer>", "T\none two"),
        ("<body><header>h</header><main><header><h1>T</h1></header><p>x</p><section id='comments'><p>no</p></section></main>", "T\nx"),
        ("<article>a<script>var t='</p>'</script><style>p{}</style><!-- no <p>no</p> -->b</article>", "ab"),
        ("<article><div class='cookie-notice'>n<div>n</div></div><p title='a > b'>y</p><form><p>q</form></article>", "y"),
        ("<article><p>cut <b>off", "cut off"), ("<article><p>cut <a href='x", "cut"), ("<p>1 < 2 &am", "1 < 2 &am"),
        ("<div class='page has-sidebar'><div id='site-header'>h</div><article class='post no-comments'><div class='entry-header'>T</div>u</article></div>", "T\nu"),
        ("<article><p>u</p><article class='comment'>c</article></article><div class='reader-comments'><p>d</p></div>", "u"),
        ("<ARTICLE><P>u</P></ARTICLE>", "u"), ("<div hidden>n</div><div style='display:none'>n</div>y", "y"),
    ],
)
def test_main_text(spark, page, text):
    rows = html_text.extract_text(spark.createDataFrame([(1, None, page)], "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in rows] == [(text, len(text))]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='content right-sidebar'><nav>m</nav><article><h1>T</h1><p>u</p></article><p>s</p></div>", "T\nu"),
        ("<div id='social-page'><main><p>u</p></main></div>", "u"),
        ("<form id='aspnetForm'><div class='menu'>m</div><article><p>u</p><div class='share'>s</div></article></form>", "u"),
        ("<main><h1>T</h1><div class='content right-sidebar'><article><p>one two</p></article></div></main>", "T\none two"),
        ("<a href='#m'>skip</a><form id='f'><div><p>one two three</p></div></form>", "skip\none two three"),
        # teasers in a sidebar, comments, related articles and adverts stay out
        ("<article><p>one two</p></article><div class='sidebar'><article><p>t</p></article></div>", "one two"),
        ("<p>one two</p><aside><article>t</article></aside><div class='related'><article>t t t t</article></div>", "one two"),
        ("<p>one two</p><div id='comments'><article>c c c c</article></div><div class='ad'><main>a a a a</main></div>", "one two"),
    ],
)
def test_main_text_inside_wrappers(page, text):
    assert html_text.host_texts([html_text.blocks(page)], 8, 3, 0.5) == [text]


def test_host_boilerplate_is_found_by_repetition(spark):
    line = "subscribe now to read all of our stories every single day"
    pages = [(i, f"http://h.example/{i}", f"<body><div>{line}</div><div>unique story number {i} about {i * 17}</div></body>") for i in range(12)]
    pages += [(50 + i, f"http://g.example/{i}", f"<article><p>{line}</p></article>") for i in range(6)]
    pages += [(99, "not a url", f"<div>{line}</div>"), (98, None, None)] + [pages[0]] * 2
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = html_text.extract_text(df, group_pages=6).collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r.page_id < 50:
            assert r.text == f"unique story number {r.page_id} about {r.page_id * 17}"
        else:
            assert r.text == ("" if r.page_id == 98 else line)
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_short_blocks_and_a_sections_boilerplate_go():
    def page(k, *more):
        story = " ".join(f"w{k}x{j}" for j in range(30))
        return [(html_text.BODY, t) for t in ("Home", "Subscribe now", *more, story, "© h")], story

    notice = "members of this section get a letter once a month for free"
    made = [page(k, *([notice, "Section news"] if k < 40 else [])) for k in range(100)]
    assert html_text.host_texts([b for b, _ in made], 8, 3, 0.5) == [story for _, story in made]
    # copies of a page are no boilerplate, nor are many near copies on a part of the host
    assert html_text.host_texts([made[0][0]] * 5, 8, 3, 0.5) == ["\n".join(t for _, t in made[0][0])] * 5
    shared = " ".join(f"s{j}" for j in range(40))
    near = [[(html_text.BODY, shared), (html_text.BODY, f"edition {k}")] for k in range(20)]
    got = html_text.host_texts(near + [b for b, _ in made[40:]], 8, 3, 0.5)
    assert got == [f"{shared}\nedition {k}" for k in range(20)] + [story for _, story in made[40:]]


def test_what_repeats_inside_articles_goes():
    share = "Share this story with your friends"
    story = [[f"title {k}", " ".join(f"w{k}x{j}" for j in range(20 + k))] for k in range(8)]
    marked = [[(html_text.ARTICLE, t) for t in (a, share, b, "Our offer of the week")] for a, b in story]
    assert html_text.host_texts(marked, 8, 3, 0.5) == ["\n".join(x) for x in story]
    # at other places, on few pages or in copies it is the article's own
    moved = [[(html_text.ARTICLE, t) for t in (*b.split()[:k], share, *b.split()[:9 - k])] for k, (_, b) in enumerate(story)]
    assert html_text.host_texts(moved, 8, 3, 0.5) == ["\n".join(t for _, t in page) for page in moved]
    few = marked[:3] + [[(html_text.ARTICLE, t) for t in x] for x in story[3:]]
    assert html_text.host_texts(few, 8, 3, 0.5) == ["\n".join(t for _, t in page) for page in few]
    copies = [[(html_text.ARTICLE, t) for t in (*story[0], f"edition {k}")] for k in range(8)]
    assert html_text.host_texts(copies, 8, 3, 0.5) == ["\n".join(t for _, t in page) for page in copies]


def test_what_repeats_is_counted_over_the_whole_host(spark):
    share, news = "share this story with all of your good friends now", "our section has news for you every day of it"
    story = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(72)]
    offer = lambda k: f"<p>{share}</p>" if k % 5 < 2 else ""  # noqa: E731 - in 40 % of the articles, so it is theirs
    pages = [(k, "http://a.example/", f"<article>{offer(k)}<p>{t}</p></article>") for k, t in enumerate(story)]
    pages += [(100 + k, "http://b.example/", f"<div>{t}</div>" + (f"<div>{news}</div>" if k % 5 < 2 else "")) for k, t in enumerate(story)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = {k: f"{share}\n{t}" if k % 5 < 2 else t for k, t in enumerate(story)}
    want |= {100 + k: f"{t}\n{news}" if k % 5 < 2 else t for k, t in enumerate(story)}
    # dealt into groups of about 8, in some of which most pages hold them
    assert {r.page_id: r.text for r in html_text.extract_text(df, group_pages=8, part_pages=8).collect()} == want


def test_a_teaser_is_not_the_text():
    pages = [html_text.blocks(f"<div>{'words of page %d ' % k * 9}</div><article class='card'>see {k}</article>") for k in range(2)]
    assert html_text.host_texts(pages, 8, 3, 0.5) == [f"{' '.join(['words of page %d' % k] * 9)}\nsee {k}" for k in range(2)]


def test_repeated_runs_by_brute_force():
    dice = np.random.default_rng(6)
    for _ in range(30):
        sizes = dice.integers(1, 25, 5)
        tokens, pages = [], []
        for p, n in enumerate(sizes):
            tokens += [*dice.integers(0, 3, n), -1 - len(tokens) - n]
            pages += [p] * (n + 1)
        where = defaultdict(set)
        for k in range(len(tokens) - 2):
            where[tuple(tokens[k : k + 3])].add(pages[k])
        want = np.zeros(len(tokens), bool)
        for k in range(len(tokens) - 2):
            run = tokens[k : k + 3]
            if min(run) >= 0 and len(where[tuple(run)]) >= 3:
                want[k : k + 3] = True
        assert (html_text.repeated_runs(np.array(tokens), np.array(pages), 3, 3) == want).all()


# ------------------------------------------------------------------ 6 sharding
@pytest.mark.parametrize("which", ["table", "awkward", "hot"])
def test_shards_hold_the_mixture(spark, odd, which, tmp_path):
    docs = {"table": documents(spark), "awkward": odd}.get(which)
    if docs is None:
        docs = spark.range(3000).select(
            F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source")
        )
    placed = shard.shard_documents(docs, shards=40, bucket_rows=100).collect()
    n = docs.count()
    assert len(placed) == n
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(40)]
    assert set(slots) <= set(range(40)) and max(sizes) - min(sizes) <= 1
    if which == "hot":
        hot = Counter(r.shard for r in placed if r.source == "hot")
        assert max(hot.values()) - min(hot.values()) <= 3  # 25 of 75 in every shard
        small = Counter((r.source, r.shard) for r in placed if r.source != "hot")
        assert max(small.values()) <= 4  # 2.5 of 75
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(((r.text or "").encode()))
    assert all((r.size - 16, r.text_crc32) in {(len(t), zlib.crc32(t)) for t in texts[r.doc_id]} for r in placed)


def test_shards_do_not_depend_on_the_files(spark):
    docs = documents(spark).select("doc_id", "text", "source")
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.where("doc_id = 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("k"))
    found = []
    for files in (1, 4):
        docs.repartition(files).write.parquet(path := scratch_path(spark, f"shard_{files}"))
        found.append(sorted(tuple(r) for r in shard.op6_shards(spark.read.parquet(path)).drop("grown_shard").collect()))
    assert found[0] == found[1] and len(found[0]) == docs.count()


def test_shards_of_nothing(spark):
    assert shard.op6_shards(empty(spark)).count() == 0


# ------------------------------------------------------------------ 7 language
def test_language_of_held_out_texts(spark):
    docs = documents(spark)
    rows = language.op7_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.95


def test_language_of_awkward_rows(spark, odd):
    rows = language.op7_language(odd).collect()
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(any(c.isalpha() for c in r.text or ""))
    assert len(rows) == odd.count()
    assert all((r.lang_pred != "und") in texts[r.doc_id] for r in rows)
    assert {r.lang_pred for r in rows} <= {"en", "de", "und"}
    nothing = language.op7_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.op7_language(empty(spark)).count() == 0


# ------------------------------------------------------------------ 8 substrings
@pytest.mark.parametrize("which", ["table", "awkward", "passages"])
def test_repeated_windows_go(spark, odd, which):
    docs = {"table": documents(spark), "awkward": odd}.get(which)
    if docs is None:
        dice = np.random.default_rng(8)
        passage = " ".join(f"p{i}" for i in range(60))
        rows = []
        for d in dice.permutation(80).tolist():
            own = [f"u{d}x{i}" for i in range(dice.integers(1, 80))]
            cut = int(dice.integers(0, len(own)))
            rows.append((d, " ".join(own[:cut]) + f"\n{passage}\t" * int(dice.integers(0, 3)) + " ".join(own[cut:])))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(docs)
    assert got.columns == [*[c for c in docs.columns if c != "dedup"], "dedup"]
    rows = [r for r in got.collect() if r.doc_id is not None]
    plain = sorted(((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None), key=lambda r: r[0])
    want = defaultdict(Counter)
    for (d, _), (n, kept) in zip(plain, without_repeats(plain), strict=True):
        want[d][n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    for r in rows:
        assert words(r.dedup.text) == words(" ".join(words(r.dedup.text))) and len(words(r.dedup.text)) == r.dedup.n_words - r.dedup.n_removed
        if not r.dedup.n_removed:
            assert r.dedup.text == (r.text or "")
        want[r.doc_id][r.dedup.n_words, r.dedup.n_removed, r.dedup.kept_sha256] -= 1
    assert not any(v for c in want.values() for v in c.values())


def test_substrings_of_nothing(spark):
    no_window = spark.createDataFrame([(1, None), (2, "a b"), (3, " ".join(f"w{i}" for i in range(25)))], "doc_id long, text string")
    assert {(r.n_words, r.n_removed) for r in substrings.op8_substrings(no_window).collect()} == {(0, 0), (2, 0), (25, 0)}
    assert {(r.n_words, r.n_removed) for r in substrings.op8_substrings(no_window.limit(2)).collect()} == {(0, 0), (2, 0)}
    assert substrings.op8_substrings(empty(spark)).count() == 0


# ------------------------------------------------------------------ 9 quality rules
def test_rules_of_awkward_rows(spark, odd):
    got = quality_rules.apply_quality_rules(odd, max_host_rate=1.0)
    assert got.columns == [*[c for c in odd.columns if c != "rules"], "rules"]
    for r in got.collect():
        want = measured(r.text)
        assert tuple(r.rules[k] for k in quality_rules.MEASURES) == want
        assert r.rules.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.rules.kept == (not r.rules.base_failed)
    assert quality_rules.op9_quality(empty(spark)).count() == 0


def test_a_bad_host_is_rejected_and_a_small_one_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(k, "bad words" if k % 50 else good, "bad") for k in range(200)]
    rows += [(1000 + k, good, f"good{k % 20}") for k in range(2000)]
    rows += [(5000, "short", "tiny"), (5001, good, "tiny"), (5002, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.rules.kept for r in quality_rules.apply_quality_rules(docs).collect()}
    assert not any(kept[k] for k in range(200))  # 98 in 100 of the host fail
    assert all(kept[1000 + k] for k in range(2000)) and kept[5001] and kept[5002]
    rate = {r.source: r.rules.shrunk_rate for r in quality_rules.apply_quality_rules(docs).collect()}
    assert rate["good1"] < rate["tiny"] < 0.5 < 0.9 < rate["bad"]


def test_rules_run_without_python(spark):
    plan = quality_rules.apply_quality_rules(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ 10 decontamination
@pytest.mark.parametrize("parts", [1, 3])
def test_hits_by_brute_force(spark, odd, parts):
    items = {1: "w5 W6, w7; w8 w9 w10 w11 w12 w13 w14 w15", 2: "a-b.c", 3: None, 4: " .. ", 5: "x x x", 6: "of7 word3 of8", 7: "é ü"}
    rows = [*items.items(), (1, items[1]), (None, "tail")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    size = decontaminate.benchmark_windows(bench, 10, "item_id", "text").agg(F.sum(F.length("pattern"))).first()[0]
    got = decontaminate.find_contamination(odd, bench, max_pattern_bytes=-(-size // parts))
    assert got.columns == [*[c for c in odd.columns if c != "contamination"], "contamination"]
    for r in got.collect():
        n, hit, found = hits(r.text, items)
        _, more, _ = hits(r.text, {0: "tail"})
        c = r.contamination
        assert (c.n_words, c.n_hit, c["items"]) == (n, len(hit | more), found)
        assert {k for s in c.word_spans for k in range(s.start, s.end)} == hit | more
        inside = sum(len(hits(r.text[s.start : s.end], items)[1] | hits(r.text[s.start : s.end], {0: "tail"})[1]) for s in c.char_spans)
        assert inside == c.n_hit


@pytest.mark.parametrize("keep_text", [True, False])
def test_items_that_share_windows_are_listed_by_spark(spark, monkeypatch, keep_text):
    shared = " ".join(f"c{k}" for k in range(12))
    bench = spark.createDataFrame([(f"item{k:05}", shared) for k in range(3000)] + [("own", "q r s")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"a {shared} b"), (2, "q r s"), (3, f"{shared} q r s"), (4, "none"), (5, None)], "_hit_numbers long, text string")
    sent = []
    scan = decontaminate._scan
    monkeypatch.setattr(decontaminate, "_scan", lambda state, patterns, *more: sent.append(patterns) or scan(state, patterns, *more))
    got = {r[0]: r.contamination["items"] for r in decontaminate.find_contamination(docs, bench, keep_text=keep_text).collect()}
    every = [f"item{k:05}" for k in range(3000)]
    assert got == {1: every, 2: ["own"], 3: [*every, "own"], 4: [], 5: []}
    assert all(len(p) == 4 for p in sent) and len(str(sent)) < 2000  # three windows and one; no list of items


def test_hits_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.op10_contamination(documents(spark), bench).collect()} == {0}
    assert decontaminate.op10_contamination(empty(spark), bench).count() == 0
