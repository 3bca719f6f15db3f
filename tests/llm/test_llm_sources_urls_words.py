"""Source divergence, URL templates and spelling variants against plain Python, with everything awkward."""

import os
import random
import re
import sys
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hard import hard_documents, hard_rows, no_documents  # noqa: E402

from rollfeat.llm import divergence, spelling, urls  # noqa: E402
from rollfeat.llm.queries import URL_RULES  # noqa: E402
from rollfeat.llm.store import Store, workers_find_package  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    workers_find_package(spark)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- source divergence -----------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def counted(rows):
    n, docs = Counter(), Counter()
    for lang, source, text in rows:
        n[(lang, source, None)] += 0
        for term, m in Counter(TERM.findall(lower(text))).items():
            n[(lang, source, term)] += m
            docs[(lang, source, term)] += 1
    return {k: (v, docs[k]) for k, v in n.items()}


@pytest.mark.parametrize("small", [1, 4, 4096])
@pytest.mark.parametrize("letters", ["abAB 1é漢\n", "aAé ", "ab "])
def test_pointer_sort_counts_terms(monkeypatch, small, letters):
    monkeypatch.setattr(divergence.sort_pointers, "__defaults__", (small,))
    pick = random.Random(small)
    for _ in range(8):
        rows = [(pick.choice(["en", "de", ""]), pick.choice("xyz"), "".join(pick.choice(letters) for _ in range(pick.choice([0, 1, 7, 300, 2000])))) for _ in range(pick.randint(1, 30))]
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
        batch = pa.RecordBatch.from_arrays(columns, ["lang", "source", "text"]).slice(pick.randint(0, len(rows) - 1))
        out = divergence.count_slice(batch).to_pylist()
        want = counted([tuple(r.values()) for r in batch.to_pylist()])
        assert len(out) == len(want)
        assert {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in out} == want


def test_pointer_sort_is_stable_and_sorted():
    pick = random.Random(1)
    words = ["".join(pick.choice("ab") for _ in range(pick.randint(1, 30))) for _ in range(3000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    at, sizes = divergence.word_pointers(data, np.array([0, len(data)]))
    order, runs = divergence.sort_pointers(data, at, sizes, 16)
    assert order.tolist() == sorted(range(len(words)), key=lambda i: (words[i], i))
    assert len(runs) == len(set(words))


def plain_divergence(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    n = counted(rows)
    out = set()
    for lang in {r[0] for r in rows}:
        sources = sorted({r[1] for r in rows if r[0] == lang})
        docs, total = Counter(), Counter()
        for (l, _, term), (m, d) in n.items():
            if l == lang and term is not None:
                docs[term] += d
                total[term] += m
        kept = [t for t in docs if docs[t] >= min_docs]

        def share(count):
            below = sum(count(t) for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count(t) + 5) // below for t in kept}

        p = {s: share(lambda t: n.get((lang, s, t), (0, 0))[0]) for s in sources}
        q = share(lambda t: total[t])
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if n.get((lang, s, t), (0, 0))[0] and p[s][t] > q[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(values[:most], 1)}
    return out


@pytest.mark.parametrize("min_docs,top,term_block,source_block", [(2, 50, 4096, 128), (2, 3, 5, 2), (10**6, 50, 4096, 128)])
def test_divergence_hard(spark, min_docs, top, term_block, source_block):
    rows = [(r[2], r[3], r[1]) for r in hard_rows()]
    # Ties, many sources, and a source with most of the rows.
    rows += [("en", f"s{i}", f"alpha beta g{i % 3} É漢字 {'x' * 40}") for i in range(9)] + [("en", "hot", "alpha alpha gamma")] * 40
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS term", "2 AS docs", "3 AS p", "4 AS kept")
    found = divergence.divergence(df, min_docs, top, term_block, source_block).collect()
    assert {tuple(r) for r in found} == plain_divergence(rows, min_docs, top)
    assert len(found) == len(set(found))


def test_divergence_empty(spark):
    result = divergence.divergence(no_documents(spark))
    assert result.collect() == [] and result.columns == ["lang", "source", "part", "item", "value", "rank"]
    one = spark.createDataFrame([(None, None, None)], "lang string, source string, text string")
    assert divergence.divergence(one).collect() == []


# --- URL templates ---------------------------------------------------------------------------------------------------


def test_host_and_path(spark):
    rows = [
        ("https://WWW.Example.ORG/es/1?q=/x#y", "www.example.org", "/es/1"),
        ("http://a.b", "a.b", ""),
        ("http://a.b?c://d/e", "a.b", ""),
        ("x://Ä.de#/z", "Ä.de", ""),
        ("a\nb://c\nd/e\nf", "c\nd", "/e\nf"),
        ("://", "", ""),
        ("no scheme/at/all", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("h://x/" + "a/" * 20_000, "x", "/" + "a/" * 20_000),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "url string")
    found = df.select("url", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")).collect()
    assert [tuple(r) for r in found] == rows


@pytest.mark.parametrize(
    "url,rule",
    [
        ("http://a.org/x", "org/"),
        ("http://org/x", "org/"),
        ("http://a.org", None),
        ("http://borg/x", None),
        ("http://example.org/es/", "example.org/es/"),
        ("http://m.example.org/en/19", "example.org/en/1"),
        ("http://m.example.org/en/29", "org/"),
        ("http://notexample.org/es/1", "org/"),
        ("http://example.com/de/1", "com/de/"),
        ("http://example.com:80/de/1", None),
        (None, None),
    ],
)
def test_longest_rule(spark, url, rule):
    row = urls.judge(spark.createDataFrame([(url,)], "url string"), URL_RULES).first()
    assert row.rule == rule
    assert row.verdict == ("block" if rule in ("example.org/es/", "example.org/en/1", "com/de/") else "allow")


def pages(spark):
    rows = []
    for host in ("a.net", "b.net"):
        rows += [(f"http://{host}/spam/{i}", 0) for i in range(40)] + [(f"http://{host}/news/{i}", 1) for i in range(40)]
        rows += [(f"http://{host}/item/slug-{chr(97 + i % 26)}{'x' * i}/p", 1) for i in range(60)]
    rows += [(f"http://new.net/{kind}/{i}", None) for kind in ("spam", "news") for i in range(30)]
    rows += [("http://a.net/" + "deep/" * 3000, 1), (None, None), ("", 0), ("http://a.net", None)]
    return spark.createDataFrame([(i, u, label) for i, (u, label) in enumerate(rows)], "page_id long, url string, label int")


def test_templates_learn(spark):
    df = pages(spark).selectExpr("*", "'x' AS verdict", "'x' AS host", "'x' AS segments", "'x' AS node", "'x' AS good", "1 AS names")
    judged = urls.judge(df, label=F.col("label"))
    assert judged.columns == ["page_id", "url", "label", "segments", "node", "good", "names", "host", "path", "template", "rule", "purity", "verdict"]
    found = judged.collect()
    assert sorted(r.page_id for r in found) == list(range(df.count()))
    by_url = {r.url: r for r in found}
    # A host without labels takes over what the same segments are worth elsewhere.
    assert {r.verdict for r in found if r.url and "/spam/" in r.url} == {"block"}
    assert {r.verdict for r in found if r.url and "/news/" in r.url} == {"allow"}
    assert by_url["http://a.net/spam/3"].template == "/spam/{n}"
    # Branches with like labels are one, slugs are one wildcard, and deep paths end in one.
    assert by_url["http://a.net/news/3"].template == "/~*/~*"
    assert by_url["http://a.net/item/slug-a/p"].template.startswith("/~*/~*/")
    assert by_url["http://a.net/" + "deep/" * 3000].template.count("/") == 4
    assert by_url[None].template == "/" and by_url[None].host == ""


def test_urls_are_native(spark):
    plan = urls.judge(pages(spark), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_urls_empty_and_without_labels(spark):
    empty = urls.judge(pages(spark).where("false"), URL_RULES)
    assert empty.collect() == []
    assert {r.verdict for r in urls.judge(pages(spark), ()).collect()} == {"allow"}


# --- spelling variants -----------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(20))
def test_scan_finds_all_words_one_edit_away(seed):
    pick = random.Random(seed)
    listed = sorted({"".join(pick.choice("abc") for _ in range(pick.randint(0, 7))) for _ in range(pick.randint(1, 90))})
    shared = [0] + [spelling.shared_prefix(a, b) for a, b in zip(listed, listed[1:])]
    for word in [*listed, "", "abcabcab"]:
        assert [listed[i] for i in spelling.one_edit_away(word, listed, shared)] == [w for w in listed if one_edit(word, w)]


@pytest.mark.parametrize("group_words", [1, 6, 4000])
def test_groups_give_every_pair_once(spark, tmp_path, group_words):
    pick = random.Random(3)
    listed = sorted({"".join(pick.choice("ab") for _ in range(pick.randint(6, 9))) for _ in range(300)} | {"a" * n for n in (6, 7, 8, 40, 41)})
    words = spark.createDataFrame([(w, i + 5) for i, w in enumerate(listed)], "word string, n long")
    found = [tuple(r) for r in spelling.near_words(words, Store(spark, "test"), group_words=group_words).collect()]
    n = {w: i + 5 for i, w in enumerate(listed)}
    assert sorted(found) == sorted((a, n[a], b, n[b]) for a in listed for b in listed if one_edit(a, b))


RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def plain_variants(rows, min_letters=6, min_count=5):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: m for w, m in n.items() if m >= min_count and len(w) >= min_letters}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda o: (-n[o], o))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def spelled_rows():
    rows = [(r[0], r[1]) for r in hard_rows()]
    for i in range(300):
        rows.append((1000 + i, "Colourful çolourful übermäßig naïveté Ærodrome " * 7))
    rows += [(5000, "colourfull " * 30 + "colourfulll " * 6 + "colorfull " * 5), (5001, "aaaaaaaa " * 200 + "aaaaaaaab " * 5), (None, "colorful " * 500), (5002, "x" * 30_000 + " ") ]
    return rows + [(5003, "q" * 3000 + "\n")] * 6


def test_variants_hard(spark):
    rows = spelled_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "'x' AS key", "'x' AS form")
    found = spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = plain_variants(rows)
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert any(r.form and r.root != r.form for r in found)


def test_variants_empty(spark):
    assert spelling.variants(no_documents(spark)).collect() == []
    assert spelling.variants(hard_documents(spark).where("text IS NULL")).collect() == []
