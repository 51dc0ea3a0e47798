"""Personal data, licenses, pages, URLs, packing, mixing, quality and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from signalstar.llm import licenses, mixing, ordinal, packing, pii, url_trees, wrappers
from signalstar.llm.queries import MIX_WEIGHTS, QUERIES, SQL, mix_levels

DATA = "/root/testdata/sf0.01"

# --- personal data -------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_base_spans(spark):
    rng = np.random.default_rng(2)
    pieces = list("ab.-+@%() 0123456789é💡") + [
        "a@b.c", "x.y@z-1.org", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+49 (0)30 123456", "..", "@@",
    ]
    texts = ["".join(rng.choice(pieces, int(rng.integers(1, 60)))) for _ in range(1500)]
    texts += [None, "", "1" * 30_000, "a" * 30_000 + "@", "a@b.c " * 3000, "1 " * 20_000, "+" + "1" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text[:200]
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("term")] == want
        assert got[i].n_email == sum(s.startswith("email") for s in want)


def test_disclosing_terms(spark):
    noise = "plain words that everybody writes every single day"
    texts = [f"{noise} Zanzibarian contact jo@mail.org please {i}" for i in range(5)]
    texts += [f"{noise} please contact number {i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    at = texts[0].index("Zanzibarian")
    assert f"term:{at}:{at + 11}" in rows[0].spans.split(",")
    assert rows[0].clean_text == f"{noise} [...] contact [email] please 0"
    assert all(rows[i].spans == "" and rows[i].clean_text is None for i in range(5, 205))


def plain_disclosure(texts, support=pii.SUPPORT, disclosure=pii.DISCLOSURE):
    """Spans and cleaned text of each document, pair by pair over whole documents."""
    texts = [t or "" for t in texts]
    base = [[(int(a), int(b), k) for k, a, b in (s.split(":") for s in plain_spans(t))] for t in texts]

    def entity(text, span):
        a, b, kind = span
        value = text[a:b]
        return kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()

    letters = r"[^\W\d_]+"
    entities = [{entity(t, s) for s in spans} for t, spans in zip(texts, base)]
    words = [set(re.findall(letters, t.lower())) for t in texts]
    n_e, n_t, n_et = Counter(), Counter(), Counter()
    for e, w in zip(entities, words):
        n_e.update(e)
        n_t.update(w)
        n_et.update((x, y) for x in e for y in w)
    n, out = len(texts), []
    for t, spans, e, w in zip(texts, base, entities, words):
        bad = {
            y for x in e for y in w
            if n_et[x, y] >= support and n_e[x] < n
            and math.log(n * n_et[x, y] / (n_e[x] * n_t[y])) >= disclosure * math.log(n / n_e[x])
        }
        added = [
            (m.start(), m.end(), "term") for m in re.finditer(letters, t)
            if m.group().lower() in bad and not any(a < m.end() and m.start() < b for a, b, _ in spans)
        ]
        order = {k: i for i, k in enumerate([*PLAIN, "term"])}
        every = sorted(spans + added, key=lambda s: (s[0], order[s[2]]))
        done, clean = 0, ""
        for a, b, kind in every:
            if a >= done:
                clean += t[done:a] + ("[...]" if kind == "term" else f"[{kind}]")
            done = max(done, b)
        out.append((",".join(f"{k}:{a}:{b}" for a, b, k in every), clean + t[done:] if every else None))
    return out


def disclosure_texts(seed):
    rng = random.Random(seed)
    common = ["the", "mail", "of", "a", "to", "zu", "straße", "日本", "ok"]
    people = [(f"{x}@site.org", [x.upper(), f"Secret{x}", "Li", "Wu"][: 2 + i % 3])
              for i, x in enumerate(["ann", "bob", "eve", "zoë"])]
    texts = [None, "", "1.2.3.4"]
    for i in range(120):
        words = rng.choices(common, k=rng.randint(0, 12)) + [f"word{chr(97 + rng.randrange(26))}"]
        for address, terms in rng.sample(people, rng.choice([0, 0, 0, 1, 2])):
            words += rng.sample(["filler"] * 90 + terms, rng.randint(1, 90)) + [address] + terms
        if i % 9 == 0:
            words += ["+49 30 1234567", "10.0.0.7", "Kiosk"]
        rng.shuffle(words)
        texts.append(rng.choice([" ", ", ", "-"]).join(words))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_disclosure_like_brute_force_and_sql(spark, seed):
    texts = disclosure_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_disclosure(texts)
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert sum("term" in spans for spans, _ in want) > 10
    for i, (spans, clean) in enumerate(want):
        assert (got[i].spans, got[i].clean_text) == (spans, clean), texts[i]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    rows = con.sql(f"SELECT doc_id, spans, n_term, clean_sha256 FROM ({SQL['op3_disclosure']})").fetchall()
    assert len(rows) == len(texts)
    for i, spans, n_term, clean_sha256 in rows:
        clean = want[i][1]
        assert spans == want[i][0] and n_term == spans.count("term:")
        assert clean_sha256 == (clean if clean is None else hashlib.sha256(clean.encode()).hexdigest())


def test_terms_at_any_distance_and_of_any_length(spark):
    far = "plain words that everybody writes " * 20
    texts = [f"Li Wu {far} jo@mail.org" for _ in range(4)] + [far + "jo at mail of org"] * 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert rows[0].spans.startswith("term:0:2,term:3:5,email:")
    assert rows[0].clean_text == f"[...] [...] {far} [email]"
    assert all(rows[i].spans == "" for i in range(4, 104))


def test_personal_data_of_odd_rows(spark):
    assert pii.personal_data(odd_documents(spark)).count() == len(TEXTS)
    assert pii.personal_data(no_documents(spark)).count() == 0
    plan = QUERIES["op3_disclosure"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- licenses ------------------------------------------------------------------------


def test_licenses(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    texts = [
        "Intro. Released under the MIT License. Outro",
        "x " * 5000 + "Licensed under CC BY-NC 4.0. And later\nLicensed under the Apache License, Version 2.0.",
        mit.replace("Software", "Program").upper(),
        "A licensed driver has permission to park.",
        "Licensed under CC BY-SA 4.0", None, "", "license " * 3000,
        "a notice (Licensed under CC BY 4.0) " * 400,
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    found = defaultdict(list)
    for r in licenses.license_notices(docs).collect():
        found[r.doc_id].append((r.start, r.end, r.license, r.differences))
    assert [(texts[0][a:b], n, d) for a, b, n, d in found[0]] == [("Released under the MIT License", "MIT", 0)]
    assert [n for _, _, n, _ in sorted(found[1])] == ["CC-BY-NC-4.0", "Apache-2.0"]
    assert [n for _, _, n, _ in found[2]] == ["MIT"] and found[2][0][3] > 0
    assert [n for _, _, n, _ in found[4]] == ["CC-BY-SA-4.0"]
    assert not {3, 5, 6, 7} & set(found)
    assert len(found[8]) == 400 and {n for _, _, n, _ in found[8]} == {"CC-BY-4.0"}
    bearing = licenses.licensed_documents(docs).where("doc_id = 0").collect()
    assert [r.notice for r in bearing] == ["Released under the MIT License"]
    assert licenses.license_notices(no_documents(spark)).count() == 0
    assert licenses.license_notices(odd_documents(spark)).count() == 0


def test_every_template_has_a_trigger():
    assert all(re.search(licenses.TRIGGER, text) for _, text in licenses.TEMPLATES)


def test_license_deciding_words():
    made, plain = licenses.prepared(licenses.TEMPLATES)

    def names(text):
        return [n[2] for n in licenses.notices(text, made, plain)]

    cc = "This work is licensed under a Creative Commons {} License."
    assert names(cc.format("Attribution-NonCommercial 4.0 International")) == ["CC-BY-NC-4.0"]
    assert names(cc.format("Attribution-NoDerivatives 4.0 International")) == ["CC-BY-ND-4.0"]
    assert names(cc.format("Attribution 3.0 Unported")) == ["CC-BY-3.0"]
    head = (
        "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
        "as published by the Free Software Foundation, either version {} of the License, or (at your "
        "option) any later version."
    )
    gpl = "General Public License"
    assert names(head.format("program", gpl, "3")) == ["GPL-3.0"]
    assert names(head.format("library", gpl, "2")) == ["GPL-2.0"]
    assert names(head.format("program", f"Affero {gpl}", "3")) == ["AGPL-3.0"]
    assert names(head.format("library", f"Lesser {gpl}", "2.1")) == ["LGPL-2.1"]
    assert names(head.format("library", f"Library {gpl}", "2")) == ["LGPL-2.0"]
    # A long altered text beside a short notice does not hide it.
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    assert names(mit[: mit.index("subject to")] + "to do so. Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    for text in ("All rights\n * reserved.", "ALL RIGHTS  RESERVED"):
        assert re.search(licenses.TRIGGER, text) and names(text) == ["Proprietary"]


# --- pages ---------------------------------------------------------------------------

ARTICLE = (
    "<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
    "<header>Site</header><div class='cookie-notice'>Accept</div><article><h1>Head {i}</h1>"
    "<p><b>Bold &amp; more<br>line<p>Second   para {i}</p><aside>side</aside><form>f</form>"
    "<script>var x='</p>';</script><!-- hidden --></article><section id=comments>"
    "<article class=comment><p>Nice!</p></article></section><footer>&copy;</footer>"
)
PLAIN_PAGE = (
    "<body><div id=top class=menu>Menu</div><div class=wrap><div class=content><p>Body text {i} "
    "goes on for a while {i}</p><ul><li>one {i}</li><li>two</li></ul></div><div class=sidebar>"
    "Links</div></div><div class=ads>Buy</div></body>"
)


def test_pages(spark):
    rows = [(i, f"http://a.org/{i}", ARTICLE.format(i=i)) for i in range(6)]
    rows += [(10 + i, f"https://b.org/{i}?q", PLAIN_PAGE.format(i=i)) for i in range(5)]
    rows += [(20, None, None), (21, "http://a.org/x", ""), (22, "nonsense", "just text"),
             (23, "http://a.org/y", "<p>no article here</p>"), (None, "http://b.org/z", "<div"),
             (25, "http://d.org/", "<div class='page has-sidebar'><main><p>Kept</p></main></div>"),
             (24, "http://c.org/", "<p>deep " * 3000), (10, "https://b.org/0?q", PLAIN_PAGE.format(i=0))]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in wrappers.main_text(pages).collect()]
    by_id = {g[0]: g for g in got}
    assert len(got) == len(rows)
    for i in range(6):
        assert by_id[i][2] == f"Head {i}\n\nBold & more line\n\nSecond para {i}"
    for i in range(5):
        assert by_id[10 + i][2] == f"Body text {i} goes on for a while {i}\n\none {i}\n\ntwo"
    assert by_id[20][1:] == (None, "", 0) and by_id[21][2] == ""
    assert by_id[22][2] == "just text" and by_id[23][2] == "no article here"
    assert by_id[24][2].count("\n\n") == 2999
    assert by_id[25][2] == "Kept"
    assert all(g[3] == len(g[2]) for g in got)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert wrappers.main_text(none).count() == 0


def test_wrapper_expression():
    pages = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>c</li></ul><i>new</i><p>x</p>"]
    node = None
    for page in pages:
        own = wrappers.fold(wrappers.parse(page))
        node = own if node is None else wrappers.align(node, own)
    assert wrappers.expression(node) == '<ul> (<li> #PCDATA </>)+ </> (<i> "new" </>)? <p> "x" </>'


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=8), min_size=2, max_size=4))
def test_wrappers_hold_every_label_once(sequences):
    """Aligned in any order, a wrapper has each child label in exactly one group."""
    made = [wrappers.fold(wrappers.parse("".join(f"<{t}x>1</{t}x>" for t in s))) for s in sequences]
    total = made[0]
    for other in made[1:]:
        total = wrappers.align(total, other)
    labels = [label for group in total["groups"] for label in group]
    assert sorted(labels) == sorted(total["kids"]) and len(set(labels)) == len(labels)
    assert total["n"] == len(sequences)


# --- URLs ----------------------------------------------------------------------------


def plain_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, h, p in url_trees.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[1]):
                best = (verdict, h + p)
    return host, path, best


def test_url_rules(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect()
    urls = [r.url for r in pages] + [
        None, "", "no scheme", "HTTP://WWW.Example.ORG/es/x?y", "http://org", "http://org/", "x://norg/",
        "a://b.example.org/en/1?x#y", "://.org/a://com/de/", "http://x.com/de/a://b", "http://h\n.com/fr/\nx",
        "http://İ.com/fr/", "http://e.org/" + "a" * 50_000,
    ]
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, label string")
    got = {r.page_id: r for r in url_trees.url_verdicts(frame).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule = plain_rule(url)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1])
        assert r.verdict == rule[0] if rule else r.verdict in ("allow", "block")
        if not host:
            assert r.verdict == "block"


def test_entropy_of_whole_paths(spark):
    paths = ["", "/", "/aab", "/" + "a" * 300 + "bcdefgh" * 50, "/é💡" * 400, "/" + "x" * 40_000 + "y" * 40_000]
    urls = spark.createDataFrame([(f"http://h.org{p}", "h.org", p) for p in paths], "url string, host string, path string")
    got = {r.path: r.f_path_entropy for r in url_trees.lexical(urls).collect()}
    for p in paths:
        shares = [p.count(c) / len(p) for c in set(p)]
        assert got[p] == pytest.approx(-sum(s * np.log2(s) for s in shares), abs=1e-9)


def test_trees_learn(spark):
    """Held-out accuracy on URLs whose label shows in their features."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        bad = bool(rng.random() < 0.5)
        name = "".join(rng.choice(list("abcdefgh0123456789" if bad else "abcdefgh"), 12))
        rows.append((f"http://{name}.net/{'x/' * int(rng.integers(0, 4))}{i}", float(bad), i % 3 == 0))
    urls = spark.createDataFrame(rows, "url string, truth double, held boolean")
    urls = urls.withColumns({"host": url_trees.host("url"), "path": url_trees.path("url"),
                             "label": F.when(~F.col("held"), F.col("truth"))})
    made = url_trees.features(urls)
    model = url_trees.fit(made)
    vectors = url_trees.VectorAssembler(inputCols=url_trees.FEATURES, outputCol="features").transform(made)
    held = model.transform(vectors.where("held")).agg(F.avg((F.col("prediction") == F.col("truth")).cast("int")))
    assert held.first()[0] > 0.9


def test_urls_without_both_verdicts(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a"), (2, "http://y.org/")], "page_id long, url string")
    assert {(r.page_id, r.verdict) for r in url_trees.url_verdicts(pages).collect()} == {(1, "allow"), (2, "allow")}
    assert url_trees.url_verdicts(pages.where("page_id < 0")).count() == 0


# --- packing -------------------------------------------------------------------------


def check_pieces(texts, rows):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = [
        (d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for d, t in texts
    ]
    ids = {}
    for d, e in encoded:
        ids.setdefault(d, []).append(e)
    covered = defaultdict(list)
    for r in rows:
        same = [e for e in ids[r.doc_id] if len(e) == r.doc_tokens
                and zlib.crc32(e[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
        assert same, r
        covered[r.doc_id].append((r.start, r.length))
    for d, pieces in covered.items():
        want = sorted(i for e in ids[d] for i in range(len(e)))
        assert sorted(i for a, n in pieces for i in range(a, a + n)) == want
    assert set(covered) == set(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0, "no sequence needs padding"


def test_packing(spark):
    texts = TEXTS + [(50, "<|endoftext|> is text"), (51, "a\x85b\xa0c\u2003d"), (52, "x" * 5000)]
    docs = odd_documents(spark).select("doc_id", "text").union(
        spark.createDataFrame(texts[len(TEXTS):], "doc_id long, text string"))
    check_pieces(texts, packing.pack_documents(docs).collect())
    assert packing.pack_documents(no_documents(spark)).count() == 0


def test_packing_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_AT_ONCE", 64)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check_pieces(texts, packing.pack_documents(docs).collect())


def test_packing_examples(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(t), int(t * rng.random())) for i, t in enumerate(rng.integers(1, 600, 800))]
    rows += [(900, 5000, 1), (901, None, 1), (902, 10, None)]
    frame = spark.createDataFrame(rows, "conv_id long, n long, loss long")
    got = packing.pack_examples(frame, "conv_id", "n", "loss", max_segments=4, max_loss=400).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.tokens, r.loss_tokens))
    alone = bins.pop(None)
    assert all(t is None or n is None or t > 1024 or n > 400 for t, n in alone)
    for items in bins.values():
        assert len(items) <= 4 and sum(t for t, _ in items) <= 1024 and sum(n for _, n in items) <= 400
    assert len(got) == len(rows)
    lower = max(sum(t for i in bins.values() for t, _ in i) / 1024, sum(len(i) for i in bins.values()) / 4)
    assert len(bins) < 1.25 * lower + 8


# --- mixing --------------------------------------------------------------------------


def plain_fill(budget, children):
    """Water filling of integer budgets: {name: (capacity, weight)}."""
    order = sorted(children, key=lambda c: (children[c][0] / children[c][1], c))
    left, weight, out = budget, sum(w for _, w in children.values()), {}
    for i, name in enumerate(order):
        capacity, w = children[name]
        if capacity * weight <= left * w:
            out[name] = capacity
            left, weight = left - capacity, weight - w
        else:
            for other in order[i:]:
                out[other] = min(left * children[other][1] // weight, children[other][0])
            break
    return out


def plain_leaves(leaves, weights, levels, budget, depth=0):
    if depth == len(levels):
        return {next(iter(leaves)): budget}
    groups = defaultdict(dict)
    for path, tokens in leaves.items():
        groups[path[depth]][path] = tokens
    given = plain_fill(budget, {
        k: (sum(v.values()), weights.get(levels[depth], {}).get(k, 1)) for k, v in groups.items()
    })
    out = {}
    for k, v in groups.items():
        out |= plain_leaves(v, weights, levels, given[k], depth + 1)
    return out


@pytest.mark.parametrize("percent,epochs", [(60, 1), (90, 3), (250, 3), (400, 3)])
def test_mixing(spark, monkeypatch, percent, epochs):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 37)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mixed(docs, mix_levels(), MIX_WEIGHTS, percent, epochs, 5).collect()
    tokens = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs.collect()}
    place = {}
    for r in docs.collect():
        place[r.doc_id] = (f"d{int(r.source[3:]) % 4}", r.lang, r.source)
    leaves = defaultdict(int)
    for d, n in tokens.items():
        leaves[place[d]] += n
    total = sum(leaves.values())
    want = plain_leaves({k: v * epochs for k, v in leaves.items()}, MIX_WEIGHTS,
                        ["domain", "lang", "source"], total * percent // 100)
    taken = defaultdict(int)
    for r in rows:
        assert r.leaf_budget == want[place[r.doc_id]]
        assert 0 < r.take_tokens <= r.tokens == tokens[r.doc_id] and 1 <= r.epoch <= epochs
        taken[place[r.doc_id]] += r.take_tokens
    assert {k: v for k, v in want.items() if v} == dict(taken)
    # Each epoch is a prefix of its own order.
    by_epoch = defaultdict(set)
    for r in rows:
        by_epoch[place[r.doc_id], r.epoch].add(r.doc_id)
    for (leaf, epoch), chosen in by_epoch.items():
        order = sorted((d for d in place if place[d] == leaf and tokens[d]),
                       key=lambda d: hashlib.md5(f"5:{epoch}:{d}".encode()).hexdigest())
        assert set(order[: len(chosen)]) == chosen


@pytest.mark.parametrize("percent,given", [(50, [60, 15, 0, 0]), (100, [100, 30, 10, 10]), (0, [0, 0, 0, 0])])
def test_children_without_weight_come_last(spark, percent, given):
    leaves = spark.createDataFrame([("a", 100), ("b", 30), ("c", 10), ("d", 10)], "k string, leaf_tokens long")
    found = mixing.leaf_budgets(leaves, ["k"], {"k": {"a": 4, "b": 1, "c": 0, "d": -2}}, percent, 1)
    assert [r.budget for r in found.orderBy("k").collect()] == given


def test_mixing_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.mixed(docs, mix_levels(), {}, 100, 1).collect()
    assert {r.doc_id for r in rows} == {d for d, t in TEXTS if (t or "").split()}
    assert mixing.mixed(no_documents(spark), mix_levels(), {}, 100, 1).count() == 0
    plan = QUERIES["op1_mixing"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("same_text", [False, True])
def test_mixing_keeps_rows_not_ids(spark, same_text):
    """Rows under one id, or none, pass up to the budget only."""
    rows = [(d, "a b c d" if same_text else f"a b c {i}", "en", "src0") for i, d in enumerate([None, 3] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    kept = mixing.kept_documents(docs, mix_levels(), {}, 40, 1)
    assert kept.columns == docs.columns
    assert kept.count() == 16 and kept.exceptAll(docs).count() == 0


# --- quality -------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit_on = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = ordinal.fit(ordinal.rated_documents(docs, labels.where(fit_on)))
    assert list(model.thresholds) == sorted(model.thresholds)
    held = ordinal.graded(docs.join(labels.where(~fit_on), "doc_id"), model)
    rows = held.select("quality", "toxic", "judged.*").toPandas()
    kept = np.stack(rows.tails)[:, 0] >= 0.5
    assert (kept == (rows.quality == 1)).mean() > 0.98
    clean = rows[(rows.quality == 1) & (rows.toxic == 0)]
    assert (np.stack(clean.tails)[:, 0] >= 0.5).mean() > 0.995
    grade = np.where(rows.quality == 0, 0, np.where(rows.toxic == 1, 1, 2))
    means = [rows.expected_grade[grade == g].mean() for g in range(3)]
    assert means == sorted(means)


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (8, 0, 0), (9, 1, 1), (9, 1, 0), (99, 1, 0), (None, 1, 0), (2, None, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = ordinal.quality_grades(docs, labels).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.p_2 <= r.p_1 <= 1 for r in rows)
    assert len({(r.score, r.p_1) for r in rows if r.doc_id in (3, 4, 5)}) == 1
    none = labels.where("doc_id < 0")
    assert all(r.kept for r in ordinal.quality_grades(docs, none).collect())
    assert ordinal.quality_grades(no_documents(spark), labels).count() == 0
    assert ordinal.kept_documents(docs, none).columns == docs.columns


def test_quality_pieces_of_long_words():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("aB9中é.") for _ in range(rng.choice((1, 5, 24, 25, 26, 27, 70))))
                      for _ in range(rng.randrange(6))) for _ in range(200)] + ["", "x" * 100_000]
    words, offsets = [], [0]
    for text in texts:
        for word in text.split():
            words.append(word)
            if len(word) > ordinal.LONG:
                words += [word[i : i + ordinal.PIECE] for i in range(0, len(word), ordinal.PIECE)]
        offsets.append(len(words))
    plain = [w for t in texts for w in t.split()]
    starts = np.cumsum([0, *[len(t.split()) for t in texts]])
    got, at = ordinal._with_pieces(pa.array(plain, pa.large_string()), starts)
    assert got.to_pylist() == words and list(at) == offsets


def test_quality_of_texts_without_spaces(spark):
    """Texts that are alike for 30 characters and in their last ones, and differ in the middle."""
    rng = random.Random(3)

    def text(letters):
        return "序" * 30 + "".join(rng.choice(letters) for _ in range(120)) + "end"

    rows = [(i, text("甲乙丙丁" if i % 2 else "子丑寅卯"), i % 2 * 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string, grade int")
    model = ordinal.fit(df.where("id < 300"))
    held = ordinal.graded(df.where("id >= 300"), model).select("grade", "judged.expected_grade").collect()
    assert max(r[1] for r in held if r[0] == 0) < min(r[1] for r in held if r[0] == 2)


def test_quality_sample_is_bounded(spark):
    """A text that fills most rows is one row of the sample; a smaller sample is really smaller."""
    rows = [("hot text of many copies", 0)] * 5000 + [(f"clean words {i}", 2) for i in range(300)]
    df = spark.createDataFrame(rows, "text string, grade int")
    model = ordinal.fit(df, train_rows=100)
    assert sorted(model.thresholds) == list(model.thresholds)
    again = ordinal.fit(df.repartition(7), train_rows=100)
    assert np.allclose(model.weights, again.weights)
    judged = ordinal.graded(df.distinct(), ordinal.fit(df)).select("grade", "judged.expected_grade").collect()
    assert max(r[1] for r in judged if r[0] == 0) < min(r[1] for r in judged if r[0] == 2)


def test_quality_keeps_columns_of_its_own_names(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS judged", "2 AS Judged_", "3 AS text_key", "4 AS grade")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = ordinal.kept_documents(docs, none)
    assert got.columns == docs.columns and got.exceptAll(docs).count() == 0 and got.count() == docs.count()


# --- pipeline ------------------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DATA)
        assert after.columns == docs.columns
        after = after.cache()
        assert 0 < after.count() <= before.count()
        assert after.exceptAll(before).count() == 0
        before = after
        if name == "exact dedup":
            norm = F.regexp_replace("text", r"[\x20\x09-\x0D]", "")
            assert after.select(norm).distinct().count() == after.count()
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    assert before.join(labels.where("quality = 0"), "doc_id").count() == 0
    texts = [(r.doc_id, r.text) for r in before.collect()]
    check_pieces(texts, corpus_pipeline.STAGES[-1][1](spark, before, DATA).collect())


def test_pipeline_of_odd_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, DATA).count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
