import math
import random

from pyspark.sql import functions as F

from wattmill.llm import language_id as li

ENGLISH = "the house and the garden were quiet that morning when they walked along the river"
GERMAN = "das haus und der garten waren still an diesem morgen als sie am fluss entlang gingen"


def rows_of(n=40):
    return [(i, f"{ENGLISH} {i}", "en", "a.site.org") for i in range(n)] + [(1000 + i, f"{GERMAN} {i}", "de", "b.site.org") for i in range(n)]


def test_sample_agrees_with_the_labels(sample):
    found = li.identify(sample).collect()
    right = sum(r.language == r.lang for r in found)
    assert len(found) == 200 and right >= 0.97 * len(found)
    assert sum(r.kept for r in found) >= 0.97 * len(found)


def test_evidence_fuses(frame):
    rows = [*rows_of(), (1, "ok 1", None, "b.site.org"), (2, "ok 1", None, "a.site.org"), (3, GERMAN, "en", "a.site.org")]
    found = {(r.doc_id, r.text): r for r in li.identify(frame(rows)).collect()}
    # hardly any text: the host decides; much text: it outweighs a wrong declaration and host
    assert found[1, "ok 1"].language == "de" and found[2, "ok 1"].language == "en"
    assert found[3, GERMAN].language == "de" and found[3, GERMAN].text_language == "de"


def test_what_is_rejected(frame):
    rows = [*rows_of(), (1, "12345 67890 !!", "en", "a.site.org"), (2, "漢字仮名交じり文の例文である" * 20, None, None)]
    found = {(r.doc_id, r.text): r for r in li.identify(frame(rows)).collect()}
    assert not found[1, rows[-2][1]].kept and not found[2, rows[-1][1]].kept
    assert all(r.kept for (d, _), r in found.items() if d not in (1, 2))


def test_every_declared_language_is_known(frame):
    draw = random.Random(3)
    rows, wanted = [], {}
    for k in range(80):  # languages with words of their own, all without a key
        words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        for i in range(2 if k == 79 else 5 + k % 3):
            text = " ".join(draw.choices(words, k=60))
            rows.append((None, text, f"l{k}", None))
            wanted[text] = f"l{k}"
    found = li.identify(frame(rows)).collect()
    assert {r.text: r.language for r in found if r.kept} == wanted


def test_pages(spark):
    html = f'<!DOCTYPE html><html class="x" lang="en-GB"><head><script>var das = 1;</script></head><body><p>{ENGLISH}</p><!-- der --></body></html>'
    pages = spark.createDataFrame([(1, "https://user@Blog.Site.example.co.uk:80/x?y", html), (2, None, None)], "page_id bigint, url string, html string")
    one, two = li.pages_as_documents(pages).orderBy("page_id").collect()
    assert (one.lang, one.host, one.suffix, one.text.split()) == ("en", "blog.site.example.co.uk", "uk", ENGLISH.split())
    assert tuple(two)[1:] == (None, None, None, None)


def test_odd_rows_and_extra_columns(frame, odd):
    rows = [*rows_of(), *((d, t, None, None) for d, t in odd)]
    docs = frame(rows, "language", "kept", "_host", "label", "prior")
    found = li.identify(docs)
    assert found.columns == [*docs.columns, "language_", "posterior", "text_language", "kept_"]
    kept = found.where(F.col("language") != "x").count()
    assert kept == 0 and found.count() == len(rows)
    assert found.where("text IS NULL AND kept_").isEmpty()


def test_without_labels_nothing_is_kept(frame):
    found = li.identify(frame([(1, ENGLISH, None, None)])).collect()
    assert [(r.language, r.kept) for r in found] == [(None, False)]
    assert li.identify(frame([])).collect() == []


def test_undetermined_is_no_declaration(frame):
    rows = [(d, t, "und" if d % 2 else lang, host) for d, t, lang, host in rows_of()]
    found = li.identify(frame(rows)).collect()
    assert all(r.kept and r.language == ("en" if r.doc_id < 1000 else "de") for r in found)


def test_codes_count_by_primary_subtag(frame, spark):
    forms = ("en", "EN", "en-GB", "En_us")
    rows = [(d, t, forms[d % 4] if lang == "en" else lang, host) for d, t, lang, host in rows_of()]
    found = li.identify(frame(rows)).collect()
    assert {r.language for r in found} == {"en", "de"} and all(r.kept for r in found)
    odd = spark.createDataFrame([("zh-Hant",), (" fr ",), ("",), (None,), ("english text",), ("zxx",), ("\u65e5\u672c",)], "c string")
    assert [r.c for r in odd.select(li.language_code(F.col("c")).alias("c")).collect()] == ["zh", "fr", None, None, None, None, None]


def test_posterior_equals_brute_force(frame):
    """The fusion restated in plain Python over the likelihoods of the texts."""
    draw = random.Random(8)
    suffixes = [f"s{k}" for k in range(70)]  # more values than any constant that stood for their number
    rows = [(i, t, draw.choice([lang, None, "fr"]), f"h{draw.randrange(3)}.{draw.choice(suffixes)}") for i, (_, t, lang, _) in enumerate(rows_of(60))]
    rows += [(500 + i, "ok", None, f"h1.{draw.choice(suffixes)}") for i in range(5)]
    docs = frame(rows).withColumn("suffix", F.substring_index("source", ".", -1))
    labels, model = li.fit(docs, "text", "lang", F.col("doc_id"))
    scored = li.with_likelihoods(docs, "text", model, "like").collect()
    every = [*labels, li.UNKNOWN]
    best = lambda like: every[max(range(len(every)), key=lambda k: (like[k], -k))]
    facts = [(r.source, r.lang, r.suffix, best(r.like), r) for r in scored]
    n = lambda *test: sum(all(f[k] == v for k, v in test) for f in facts)
    whole = [(n((3, v)) + 1) / (len(facts) + len(every)) for v in every]
    want = {}
    for host, label, suffix, _, r in facts:
        # no host here has a domain above it, so its prior is smoothed towards the corpus
        logs = []
        for k, v in enumerate(every):
            x = r.like[k] + math.log((n((0, host), (3, v)) + li.WEIGHT * whole[k]) / (n((0, host)) + li.WEIGHT))
            for column, value in ((1, label), (2, suffix)):
                if value is not None:
                    having = sum(f[column] is not None and f[3] == v for f in facts)
                    x += math.log((n((column, value), (3, v)) + 1) / (having + len({f[column] for f in facts if f[column] is not None})))
            logs.append(x)
        top = max(logs)
        want[r.doc_id] = (every[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs))
    found = {r.doc_id: (r.language, r.posterior) for r in li.identify(docs, suffix="suffix").collect()}
    assert all(found[d][0] == v and abs(found[d][1] - p) < 1e-9 for d, (v, p) in want.items())


def test_pages_with_nulls_and_repeated_rows(spark):
    html = f'<html lang="EN"><body>{ENGLISH}</body></html>'
    rows = [(1, "http://a.org/x", html), (1, "http://a.org/x", html), (2, None, html), (3, "x/y", html), (4, "http://a.org", None), (None, "http://a.org", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = li.identify(li.pages_as_documents(pages), host="host", suffix="suffix", key="page_id").collect()
    assert len(found) == len(rows)
    assert [r.kept for r in sorted(found, key=lambda r: (r.page_id is None, r.page_id))] == [True, True, True, True, False, False]
    none = li.pages_as_documents(pages.where("page_id > 9"))
    assert li.identify(none, host="host", suffix="suffix", key="page_id").collect() == []
