"""HTML extraction, language ID, line quality and the pipeline."""

import html
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm import crf, html_blocks, html_crf, language_id, packing, quality_crf
from tallyloom.llm.queries import QUERIES, table
from tests.llm.test_ngram_join import plain_classes
from tests.llm.test_tokens import check_packing


def all_labellings(length):
    return [[n >> i & 1 for i in range(length)] for n in range(1 << length)]


def test_marginals_and_viterbi_equal_enumeration():
    rng = np.random.default_rng(0)
    model = crf.ChainCrf(np.zeros(3), np.ones(3), rng.normal(size=3), 0.3, rng.normal(size=(2, 2)))
    lengths = np.array([1, 4, 0, 7, 2])
    rows = rng.normal(size=(14, 3))
    marginals, labels, at = model.marginals(rows, lengths), model.viterbi(rows, lengths), 0
    for length in lengths.tolist():
        scores = model.scores(rows[at : at + length])
        ways = all_labellings(length)
        value = [sum(s * y for s, y in zip(scores, w)) + sum(model.transitions[a, b] for a, b in zip(w, w[1:])) for w in ways]
        weights = np.exp(value) / np.exp(value).sum()
        assert np.allclose(marginals[at : at + length], weights @ np.array(ways).reshape(len(ways), length))
        assert labels[at : at + length].tolist() == ways[int(np.argmax(value))]
        at += length


def test_training_gradient_finds_the_labels():
    rng = np.random.default_rng(1)
    lengths = np.full(200, 9)
    labels = np.repeat(rng.integers(0, 2, 200), 9)
    rows = np.column_stack([labels + rng.normal(size=1800), rng.normal(size=1800)])
    model = crf.fit(rows, labels, lengths)
    plain = ((rows[:, 0] > 0.5) == labels).mean()
    assert (model.viterbi(rows, lengths) == labels).mean() > plain + 0.05
    assert crf.fit(np.zeros((0, 2)), np.zeros(0), np.zeros(0, int)).marginals(np.zeros((2, 2)), np.array([2])).min() > 0.9


PAGE = """<html lang="en"><body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp;  title</h1><p>First&nbsp;line<br>of <b>text</b>.<p>Second one, which is a little longer.
<div class="ad">Buy things</div><ul><li>one item of it<li>another item</ul></article>
<div id="comments"><p>Nice!</p><p>I do not agree with this at all, sorry to say.</p></div><form><label>Mail</label></form><footer>&copy; Us</footer>"""


def test_extraction_of_one_page():
    model = html_crf.trained_model()
    expected = "A & title\n\nFirst line of text.\n\nSecond one, which is a little longer.\n\none item of it\n\nanother item"
    odd = ["", "<p", "<!-- x", "<script>var a = '<p>x</p>'", "<article><p>Only this text here, of one page.</p>", PAGE]
    texts = html_crf.main_texts(model, odd)
    assert texts[-1] == expected
    assert texts[:4] == ["", "", "", ""] and texts[4] == "Only this text here, of one page."
    assert html_crf.main_texts(model, []) == [] and html_crf.main_texts(model, [""]) == [""]


def test_blocks_survive_bad_markup():
    deep = "<div>" * 3000 + "text" + "</div>" * 10
    assert [b.text for b in html_blocks.leaf_blocks(deep)] == ["text"]
    assert html_blocks.visible_text("<p>a<table><tr><td>b<td>c</table></p>d</b></div>e") == "a\nb\nc\nde"
    assert html_blocks.visible_text("a < b &lt; c <em title='>'>d</em> 1<2") == "a < b < c d 1<2"
    assert html_blocks.visible_text("<title>no</title><textarea><p>no</textarea>x <b title=\"y>z</b> w") == "x z w"
    assert html_blocks.leaf_blocks(None) == []


@pytest.mark.parametrize("start", ["<body>", "<body><p>", "<div>", "<img src=x>", "<a href=/>", ""])
def test_an_open_head_ends_where_the_body_starts(start):
    page = f"<html><head><meta charset=utf-8><title>no</title><script>no()</script>\n<style>no</style><noscript>no</noscript>{start}Text <p>more</html>"
    assert html_blocks.visible_text(page) == "Text\nmore"
    assert html_blocks.visible_text(page.replace(start + "Text", "</head>" + start + "Text")) == "Text\nmore"
    assert html_blocks.visible_text("<html><head><title>no</title><p>a</p><head><p>b") == "a\nb"
    assert html_blocks.visible_text(f"<head><noscript><link rel=x>{start}Text") == "Text"


def test_whole_text_of_a_page_without_end_of_head():
    texts = html_crf.main_texts(html_crf.trained_model(), [PAGE, PAGE.replace("<body>", "<head><meta name=a><title>T</title><body>")])
    assert texts[0] == texts[1] != ""


@pytest.mark.parametrize("name", ["noscript", "svg", "math", "object", "select", "datalist", "canvas", "audio", "video", "map"])
def test_open_unseen_elements_do_not_swallow_the_page(name):
    inside = "<option>no" if name in ("select", "datalist") else "<path d=x>" if name in ("svg", "math") else ""
    assert html_blocks.visible_text(f"<div>a<{name} id=x>{inside}<p>b</p>c</div><p>d") == "a\nb\nc\nd"
    closed = f"<{name}>no</{name}>"
    assert html_blocks.visible_text(f"<div>a<{name}>{inside}<p>b{closed}</p>c</div>") == "a\nb\nc"
    assert html_blocks.visible_text(f"<div>a{closed}<p>b</p></div>") == "a\nb"


def test_html_within_foreign_content_stays_unseen():
    assert html_blocks.visible_text("a<svg><foreignObject><p>no</p></foreignObject><text>no</text></svg>b") == "ab"
    assert html_blocks.visible_text("a<video><p>no</p></video>b<select><option>no</select>c") == "abc"


def test_held_out_pages_are_labelled_right():
    model, wrong, blocks = html_crf.trained_model(), 0, 0
    for seed in range(50_000, 50_200):
        page, marks = html_crf.labelled_page(seed)
        found = html_blocks.leaf_blocks(page)
        if found:
            labels = model.viterbi(html_crf.block_features(found), np.array([len(found)]))
            wrong += sum(dict(marks).get(b.text) != bool(y) for b, y in zip(found, labels))
            blocks += len(found)
    assert wrong <= 0.02 * blocks


def test_extraction_query(spark, sf_dir):
    pages = {r["page_id"]: r for r in table(spark, sf_dir, "pages").collect()}
    rows = QUERIES["op6_html_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?h1>|</?p>", inside)]
        assert r["text"] == "\n\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_extraction_edges(spark):
    rows = [(1, None, None, 9), (None, "u", "", 9), (2, "u", PAGE, 9), (2, "u", PAGE, 9), (3, "u", "<p>" + "long word " * 40_000, 9)]
    found = html_crf.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert len(found) == 5 and sum(r["text"] == "" for r in found) >= 2
    assert html_crf.extract(spark.createDataFrame([], "page_id long, url string, html string, n_chars int")).count() == 0


WORDS = {"en": "the and of this that with for was", "de": "der die und nicht mit von das ein", "fr": "le la et des que dans une pour"}


def language_rows(spark, n=240):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(60)), lang, f"src{i % 3}", 1, "p"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, p string")


def test_language_model_and_fusion(spark):
    docs = language_rows(spark)
    model = language_id.train(docs)
    assert model.languages == ["de", "en", "fr", "und"]
    rows = [
        (1, "und nicht mit der von das", "de", "com/de", "a.x.org", "x.org"), (2, "the und", "de", "com/de", "de.x.org", "x.org"),
        (3, None, None, None, None, None), (4, "", "fr", None, None, None), (5, "1234 %%%", None, None, None, None),
        (None, "the and of this", None, None, None, None), (6, "qzxj wvkq jjxq zzqx " * 30, None, None, None, None),
        (7, "the and " * 20_000, "fr", None, "b", "b"), (7, "the and " * 20_000, "fr", None, "b", "b"),
    ]
    rows += [(100 + i, " ".join(WORDS["de"].split() * 4), "de", "com/de", "de.x.org", "x.org") for i in range(20)]
    rows += [(200 + i, " ".join(WORDS["en"].split() * 4), "en", "com/en", "en.y.org", "y.org") for i in range(20)]
    frame = spark.createDataFrame(rows, "id long, t string, declared string, suffix string, host string, parent string")
    found = language_id.identify(frame, model, "id", "t", "declared", "suffix", "host", "parent").collect()
    by_id = {r["key"]: r for r in found}
    assert len(found) == len(rows)
    assert by_id[1]["language"] == "de" and by_id[7]["language"] == "en" and by_id[None]["language"] == "en"
    assert by_id[2]["language"] == "de"  # the host, the address and the markup outweigh two words
    assert by_id[3]["language"] == "und" and by_id[5]["language"] == "und" and by_id[6]["language"] == "und"
    assert not any(by_id[i]["accepted"] for i in (3, 4, 5, 6)) and by_id[1]["accepted"]
    assert language_id.identify(frame.limit(0), model, "id", "t", "declared").count() == 0


def test_every_label_is_learned(spark):
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in [*range(0x430, 0x450), *range(0x561, 0x587), *range(0x5D0, 0x5EB)]]
    words = {f"l{i:02}": ["".join(rng.choice(letters, 5)) for _ in range(12)] for i in range(40)}
    rows = [(i, " ".join(rng.choice(words[f"l{i % 40:02}"], 60)), f"l{i % 40:02}", f"s{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.train(docs)
    assert model.languages == [*sorted(words), "und"]
    assert language_id.keep_identified(docs, model).count() == len(rows)


def test_rare_labels_are_learned_from_a_small_sample(spark):
    rare = "och det att som en på är av för med"
    docs = language_rows(spark, 600).union(
        spark.createDataFrame([(1000 + i, rare + " " + " ".join(rare.split()[i:]) * 4, "sv", "src9", 1, "p") for i in range(3)], "doc_id long, text string, lang string, source string, n long, p string")
    )
    model = language_id.train(docs, sample=10)
    assert model.languages == ["de", "en", "fr", "sv", "und"]
    assert language_id.keep_identified(docs, model).where("lang = 'sv'").count() == 3


def test_an_unlearned_language_is_no_reason_to_reject(spark):
    model = language_id.train(language_rows(spark))
    text = "αβγδ εζηθ ικλμ νξοπ " * 30
    rows = [(1, text, "el", "a"), (2, text, None, "a"), (3, text, "en", "a"), (4, " 12 ", "el", "a"), (5, "the and of this that with for was " * 9, "el", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["key"]: r for r in language_id.identify(docs, model, "doc_id", "text", "lang", None, "source").collect()}
    assert found[1]["accepted"] and found[1]["language"] == "el"
    assert not found[2]["accepted"] and not found[3]["accepted"] and not found[4]["accepted"]
    assert found[5]["accepted"] and found[5]["language"] == "en"
    assert sorted(r["doc_id"] for r in language_id.keep_identified(docs, model).collect()) == [1, 5]


def test_language_query(spark, sf_dir):
    rows = QUERIES["op7_language_id"](spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "pages").count()
    assert sum(r["language"] == r["declared"] for r in rows) >= 0.98 * len(rows)
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs), "doc_id", "text").collect()  # text alone
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert sum(r["language"] == truth[r["key"]] for r in found) >= 0.97 * len(truth)


def test_addresses(spark):
    from pyspark.sql import functions as F

    urls = ["https://u:p@M.Ex.co.uk:80/fr/x", "http://a.de/", "http://a.de/en-GB/", "nothing", None, "http://h"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    host = language_id.host_of(F.col("u"))
    found = [tuple(r) for r in frame.select(host, language_id.parent_of(host), language_id.suffix_of(F.col("u"))).collect()]
    assert found[:3] == [("m.ex.co.uk", "co.uk", "uk/fr"), ("a.de", "a.de", "de"), ("a.de", "a.de", "de/en")]
    assert found[5] == ("h", "h", "h") and found[3][0] is None
    tag = language_id.declared_in(F.lit("<!doctype html><html class=x lang='FR-ca'>"))
    assert frame.select(tag).first()[0] == "fr"


def test_quality_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op8_line_quality"](spark, sf_dir).collect()}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    marks = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect() if r["doc_id"] in rows}
    out = [i for i in marks if rows[i]["held_out"]]
    assert sum(rows[i]["predicted"] == marks[i] for i in out) >= 0.95 * len(out)


def test_quality_edges(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    good, bad = "Some plain words of text, said once.\nAnd a second line follows it here.", "BUY!! NOW!! CHEAP!!\n$$$ %%% ###"
    docs = documents([(i, good if i % 2 else bad) for i in range(40)] + [(50, None), (51, ""), (None, good), (1, good), (52, "\n" * 5000), (53, "x " * 60_000)])
    model = quality_crf.train(docs, labels)
    found = quality_crf.score_documents(docs, model)
    rows = found.collect()
    assert len(rows) == 46 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows if r["doc_id"] is not None and r["doc_id"] < 40)
    assert not next(r for r in rows if r["doc_id"] is None)["held_out"]
    kept = quality_crf.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0) for r in rows if r["predicted"]
    )
    assert quality_crf.score_documents(docs.limit(0), model).count() == 0
    assert quality_crf.train(docs, labels.limit(0)).marginals(np.zeros((1, 41)), np.array([1]))[0] > 0.9


@pytest.fixture(scope="module")
def library():
    from tallyloom.llm import encoder

    return encoder.load_tokenizer(encoder.vocabulary_path())


def test_stages(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality", "near_duplicates", "packing"]
    spoken = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert spoken.columns == docs.columns and spoken.count() >= 0.97 * len(texts)
    good = corpus_pipeline.keep_quality(spark, spoken, sf_dir)
    marks = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    judged = [i for i in texts if i in marks]
    assert sum((i in kept) == (marks[i] == 1) for i in judged) >= 0.95 * len(judged)
    single = corpus_pipeline.drop_near_duplicates(spark, good, sf_dir)
    assert single.columns == docs.columns
    ids = sorted(r["doc_id"] for r in single.collect())
    assert ids == sorted(i for i, _, root in plain_classes([(i, texts[i]) for i in kept], 5, 80) if i == root)
    packed = corpus_pipeline.pack(spark, single, sf_dir).collect()
    check_packing(packed, [(i, texts[i]) for i in ids], library, 2048)


def test_stages_with_clashing_columns(spark, documents, sf_dir):
    docs = documents([(i, f"words of text number {i} " * 20) for i in range(6)])
    for name in ("key", "copy_id", "rep", "digest", "node", "component", "n", "p", "host", "score"):
        docs = docs.withColumn(name, docs["n_chars"])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and kept.count() <= 6
    assert corpus_pipeline.pack(spark, docs, sf_dir).count() == 6


def test_stages_on_odd_rows(spark, documents, sf_dir):
    rows = [(1, None), (2, ""), (3, "words of a text " * 30), (3, "words of a text " * 30), (4, "words of a text " * 30), (None, "no id here"), (None, None)]
    docs = documents(rows)
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.keep_quality, corpus_pipeline.drop_near_duplicates):
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    left = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left) == [(False, 1), (False, 2), (False, 3), (True, 0), (True, 0)]
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_pipeline_query(spark, sf_dir):
    assert corpus_pipeline.ORACLE_SQL is None
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns[:3] == ["doc_id", "piece", "start"] and rows.count() > 0


def test_pipeline_keeps_other_texts_of_repeated_ids(spark, documents, sf_dir):
    words = lambda seed: " ".join(f"w{seed}x{i}" for i in range(40))
    rows = [(1, words(1)), (7, words(1)), (7, words(7)), (9, words(9)), (9, words(90)), (9, words(9)), (12, words(90)), (None, words(9)), (13, None), (13, "")]
    left = corpus_pipeline.drop_near_duplicates(spark, documents(rows).repartition(4), sf_dir)
    assert left.columns == documents(rows).columns
    found = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    kept = {(i, t) for i, t in found}
    assert len(found) == len(kept)
    assert {t for _, t in found if t} == {words(n) for n in (1, 7, 9, 90)}
    assert {(1, words(1)), (7, words(7)), (None, words(9)), (13, None), (13, "")} <= kept and (7, words(1)) not in kept
    assert sum(t == words(90) for _, t in found) == 1 and sum(t == words(9) for i, t in found if i) == 1
