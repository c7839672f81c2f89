"""Each operator against brute force, and on nulls, empty texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
from base64 import b32encode
from collections import Counter

import numpy as np
import pytest

from checks.compare import as_lists
from rillet.llm import near_dedup
from rillet.llm.arc import archive
from rillet.llm.common import shared_folder
from rillet.llm.components import contracted, replaced
from rillet.llm.decontaminate import ItemsOfSize, Search, clean, leaks
from rillet.llm.exact_dedup import deduplicated, exact_groups
from rillet.llm.html_text import extract, main_text, parse
from rillet.llm.langid import identify, learn, recognised, training_texts
from rillet.llm.mixing import Mix, mix_documents, mixed
from rillet.llm.near_dedup import near_groups, representatives
from rillet.llm.pii import CARD, DIGIT, IP, PHONE, base_spans, is_luhn, personal_data, shape
from rillet.llm.queries import ORACLES, QUERIES
from rillet.llm.suffix_dedup import Repeats, _by_counting, _by_sorting, without_repeats
from rillet.llm.suffix_sort import deep_shallow_order
from rillet.llm.token_counts import encoding, token_counts

SF = "/root/testdata/sf0.001"
#: Extra columns with names that operators use inside, nulls, ties, repeated rows, a long text.
ROWS = [
    (1, "One two three four five six seven", "a", "en", 1), (2, "ONE two three four five six seven", "b", "en", 2),
    (3, None, None, None, None), (4, "", "a", None, 4), (5, " \t\n", "b", "de", 5), (5, " \t\n", "b", "de", 5),
    (None, "eins zwei drei", "a", "de", 7), (8, "123 456", "c", "en", 8), (9, "lang " * 20_000, "c", "en", 9),
    (10, "eins zwei drei vier", None, "de", 10),
]
DOCS = "doc_id long, text string, source string, lang string, size long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).selectExpr("*", "1 AS key", "2 AS salt", "3 AS hash", "4 AS id", "5 AS copies").cache()


@pytest.fixture(scope="module")
def tables():
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_agrees_with_duckdb(spark, tables, name):
    result = QUERIES[name](spark, SF)
    cursor = tables.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert as_lists(result.columns, result.collect()) == as_lists(columns, cursor.fetchall())


@pytest.mark.parametrize("run", [
    mix_documents, exact_groups, near_groups, personal_data, token_counts, without_repeats, deduplicated, mixed, representatives,
    lambda d: identify(d, learn(training_texts(d))), lambda d: recognised(d, learn(training_texts(d))),
    lambda d: leaks(d, d.selectExpr("doc_id AS item_id", "text")), lambda d: clean(d, d.selectExpr("doc_id AS item_id", "text")),
])
def test_empty_table(docs, run):
    assert run(docs.limit(0)).collect() == []


def test_mix(docs):
    rows = mix_documents(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id: r.size for r in rows}[3] == 0 and sum(r["size"] for r in rows) == 20_000 + 7 + 7 + 3 + 2 + 4
    assert all(r.taken <= 3 * r["size"] for r in rows)
    small = {r.doc_id: r.copies for r in mix_documents(docs, Mix(share=0.3)).collect()}
    large = {r.doc_id: r.copies for r in mix_documents(docs, Mix(share=0.9)).collect()}
    assert all(small[x] <= large[x] for x in small)
    kept = mixed(docs)
    assert set(kept.columns) == set(docs.columns)
    assert kept.count() == sum(r.copies > 0 for r in rows)


@pytest.mark.parametrize("hash_bits", [128, 4])
def test_exact_groups(docs, hash_bits):
    rows = exact_groups(docs, keep="largest", hash_bits=hash_bits).collect()
    groups = {}
    for doc_id, text, *_ in ROWS:
        groups.setdefault((text or "").lower(), []).append(doc_id)
    assert sorted((r.group_size for r in rows)) == sorted(len(g) for g in groups.values() for _ in g)
    assert sum(r.kept for r in rows) == len(groups)
    assert {r.keep_id for r in rows if r.doc_id in (1, 2)} == {2} and {r.keep_id for r in rows if r.doc_id in (3, 4)} == {4}
    kept = deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_languages(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    found = identify(rows, learn(training_texts(rows))).join(rows.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95 and all(0 <= r.score <= 1 for r in found)
    tiny = {r.doc_id: r for r in identify(docs, learn(training_texts(rows))).collect()}
    assert {x for x, r in tiny.items() if r.lang_pred == "und"} == {3, 4, 5, 8}
    assert {r.doc_id for r in recognised(docs, learn(training_texts(rows))).collect()} == {1, 2, None, 9, 10}


def _components(texts):
    sets = {}
    for doc_id, text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[doc_id] = {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set()
    group = {x: x for x in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {x: low if g == high else g for x, g in group.items()}
    return {x: (len(sets[x]), group[x]) for x in sets}


def test_near_groups(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(rows).collect()}
    assert found == _components([(r.doc_id, r.text or "") for r in rows.collect()])
    tiny = [(r.doc_id, r.component_id, r.kept) for r in near_groups(docs).collect()]
    assert len(tiny) == len(ROWS) and {(1, 1, True), (2, 1, False), (3, 3, True), (None, None, True)} <= set(tiny)
    assert representatives(docs).columns == docs.columns


def _crowd(size, planted):
    """Documents that share a template and are 0.70 to 0.74 similar; some pairs are 0.75 to 0.80 similar."""
    rng = random.Random(6)
    template = [f"t{n}" for n in range(104)]
    tails = [[f"u{n}x{k}" for k in range(rng.choice((18, 19, 20, 21)))] for n in range(size)]
    for n in range(planted):
        left, right = 2 * n, size - 1 - 2 * n
        tails[left] = [f"u{left}x{k}" for k in range(20)]
        tails[right] = tails[left][: 3 + n % 4] + [f"u{right}x{k}" for k in range(17 - n % 4)]
    return [(n, " ".join(template + tail)) for n, tail in enumerate(tails)]


def _fast_components(texts):
    """As ``_components``; common shingles are counted shingle by shingle."""
    sets, holders = [], {}
    for place, (_, text) in enumerate(texts):
        words = text.lower().split()
        sets.append({tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))})
        for shingle in sets[-1]:
            holders.setdefault(shingle, []).append(place)
    common = np.zeros((len(texts), len(texts)), np.int32)
    for places in holders.values():
        if len(places) > 1:
            common[np.ix_(places, places)] += 1
    sizes = np.array([len(x) for x in sets])
    np.fill_diagonal(common, sizes)
    linked = 100 * common >= 75 * (sizes[:, None] + sizes - common)
    group = np.arange(len(texts))
    for _ in range(len(texts)):
        least = np.where(linked, group, len(texts)).min(axis=1)
        if (least == group).all():
            break
        group = least
    return {doc: texts[least][0] for (doc, _), least in zip(texts, group, strict=True)}


def test_links_inside_a_crowd(spark):
    texts = _crowd(2000, 40)
    found = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    expected = _fast_components(texts)
    assert sum(doc != group for doc, group in expected.items()) == 40
    assert found == expected


def test_crowd_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PIECE", 50)
    texts = _crowd(300, 20) + [(1000 + n, f"{text} v{n}") for n, (_, text) in enumerate(_crowd(20, 0))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    members = spark.createDataFrame([(doc, doc) for doc, _ in texts], "id long, label long")
    signed = near_dedup._signatures(docs, near_dedup.Forest()).withColumnRenamed("doc_id", "id")
    links = near_dedup._crowd_links(docs, signed, members, near_dedup.Forest()).collect()
    group = {doc: doc for doc, _ in texts}
    for a, b in sorted(tuple(r) for r in links):
        low, high = sorted((group[a], group[b]))
        group = {x: low if g == high else g for x, g in group.items()}
    assert group == _fast_components(texts)


def test_link_with_unlike_signatures(spark):
    forest, rng = near_dedup.Forest(), random.Random(9)
    agree = 128
    while agree >= 77:
        words = [str(rng.randrange(10**9)) for _ in range(8)]
        texts = [" ".join(words[:7]), " ".join(words)]
        left, right = (near_dedup.signature(near_dedup.shingle_set(x), forest) for x in texts)
        agree = int((left == right).sum())
    rows = near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.component_id for r in rows] == [0, 0]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    for left, right, common in [(3, 4, 3), (300, 280, 250), (300, 200, 0), (20, 900, 10), (1, 1, 1)]:
        pool = rng.integers(0, 1 << 63, left + right - common, np.uint64)
        a, b = near_dedup.parities(pool[:left]), near_dedup.parities(pool[left - common :])
        only = left + right - 2 * common
        assert min(only, 100) // 2 <= near_dedup.differing(a, b) <= only and near_dedup.differing(a, b) % 2 == only % 2


@pytest.mark.parametrize("two", [False, True])
def test_pairs_of_a_cell(monkeypatch, two):
    monkeypatch.setattr(near_dedup, "PAIRS", 100)
    rng = np.random.default_rng(8)
    n = np.sort(rng.integers(20, 60, 200))
    cell = np.stack([np.arange(200), np.where(rng.random(200) < 0.6, 0, rng.integers(0, 30, 200)), n, n - rng.integers(0, n // 4 + 1), rng.integers(0, 2, 200)])
    _, labels, _, rest, pieces = cell
    expected = {
        (a, b) for b in range(200) for a in range(b)
        if labels[a] != labels[b] and 175 * min(rest[a], rest[b]) >= 75 * (n[a] + n[b]) and 4 * n[a] >= 3 * n[b] and (not two or pieces[a] != pieces[b])
    }
    found = [pair for batch in near_dedup._cell_pairs(cell, two, 75) for pair in zip(*batch.to_pydict().values(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == expected and expected


def test_components_of_paths_and_stars(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(500, n) for n in range(200, 260)] + [(7, 7)]
    tables = contracted(spark.createDataFrame(edges, "a long, b long"))
    nodes = spark.createDataFrame([(n, n) for n in [7, *range(100, 161), *range(200, 260), 500]], "node long, c long")
    found = dict(replaced(nodes, "c", tables).collect())
    assert found == {n: 7 if n == 7 else 100 if n < 161 else 200 for n in found}


def test_fingerprint_search_finds_all_within_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, 30, np.uint64)
    index = ItemsOfSize(9, list(range(30)), prints, Search())
    windows = np.concatenate([prints ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, False))) for n in (0, 5, 19, 25)])
    expected = {(w, i) for w in range(len(windows)) for i in range(30) if int(windows[w] ^ prints[i]).bit_count() <= 19}
    assert set(zip(*(x.tolist() for x in index.within(windows)), strict=True)) == expected


def test_leaks(spark, docs):
    rng = random.Random(2)
    words = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n)]
    items = [(n, words(rng.randrange(3, 50))) for n in range(30)] + [(30, [])]
    texts = []
    for n in range(60):
        item = list(items[n % 30][1])
        if n % 3 == 1:
            item[rng.randrange(len(item))] = "changed"
        texts.append((n, words(rng.randrange(40)) + (item if n % 3 < 2 else item[: len(item) // 2]) + words(rng.randrange(40))))
    expected = set()
    for n, text in texts:
        for item, content in items[:30]:
            size, width = min(len(text), len(content)), min(5, len(content), len(text))
            cut = lambda x: Counter(tuple(x[k : k + width]) for k in range(len(x) - width + 1))  # noqa: B023, E731
            for start in range(len(text) - size + 1):
                a, b = cut(text[start : start + size]), cut(content)
                if sum((a & b).values()) / sum((a | b).values()) >= 0.75:
                    expected.add((n, item))
    frame = lambda rows, name: spark.createDataFrame([(n, "! ".join(x).upper()) for n, x in rows], f"{name} long, text string")
    for search in (Search(), Search(items=7, stretch=16)):
        found = leaks(frame(texts, "doc_id"), frame(items, "item_id"), search).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
    assert {r.doc_id for r in leaks(docs, spark.createDataFrame([(1, "two three four five")], "item_id long, text string")).collect()} == {1, 2}


def test_archive(spark):
    pages = [(3, "http://a/x y", "<p>é</p>", 1), (1, None, "<p>é</p>", 1), (2, "http://b", None, 1), (4, "http://b", "", 1),
             (5, "u", "a\r\n\r\nWARC/1.1\n\nb\r\n\r\n", 1), (5, "u", "a\r\n\r\nWARC/1.1\n\nb\r\n\r\n", 1), (None, "v", "x" * 100_000, 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest int").repartition(3)
    rows = archive(frame, shared_folder(spark)).collect()
    named = lambda html: b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted(
        (str(page), len((html or "").encode()), named(html)) for page, _, html, _ in pages)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in rows) == Counter(
        [(1, "response", None), (3, "revisit", 1), (2, "response", None), (4, "revisit", 2), (5, "response", None), (5, "revisit", 5), (None, "response", None)])
    assert archive(frame.limit(0), shared_folder(spark)).collect() == []
    assert {r.record_type for r in archive(frame, shared_folder(spark), min_bytes=10**6).collect()} == {"response"}


def test_personal_data(spark, docs):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip, card = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")

    def plain(text):
        found = [(m.start(), 0, m.end()) for m in email.finditer(text)]
        found += [(m.start(), 1, m.end()) for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
        found += [(m.start(), 2, m.end()) for m in card.finditer(text)
                  if 14 <= len(DIGIT.findall(m[0])) <= 19 and is_luhn("".join(DIGIT.findall(m[0])))]
        return sorted(found + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15])

    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice("a.@-+ 0123456789().%") for _ in range(rng.randrange(60)))
        assert base_spans(text) == plain(text), text
    assert IP.flags and CARD.flags
    texts = ["mail é anna.b@x.org now", "call (555) 123-4567.", "4111 1111 1111 1111", "page 12 of 300 in 2024-01-05", None]
    rows = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.spans for r in rows] == ["email:7:19", "phone:5:19", "card:0:19", "", ""]
    assert [r.base_sha256 for r in rows][1] == hashlib.sha256(b"").hexdigest()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows] == [(1, 0, 0, 0), (0,) * 4, (0, 0, 1, 0), (0,) * 4, (0,) * 4]


def test_shape_of_a_long_token():
    token = "anna." * 12 + "b[at]example.org1234567"
    assert shape(token) == "a." * 12 + "a[a]a.a0000"


def test_deep_shallow_order():
    rng = random.Random(4)
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(40))) for _ in range(300)] + [b"x" * 90 + bytes([n]) for n in range(9)] + [b"x" * 90] * 3
    for shallow in (0, 8, 32):
        assert [strings[n] for n in deep_shallow_order(strings, 0, shallow)] == sorted(strings)


@pytest.mark.parametrize("method", [_by_sorting, _by_counting])
def test_one_range_for_each_segment(spark, method):
    """However many strings a segment shares with others: the number of ranges is that of the segments."""
    rule, picks = Repeats(40, 20), random.Random(5)
    base = picks.randbytes(59)
    rows = []
    for n in range(60):
        left, right = bytearray(base[:19]), bytearray(base[19:])
        left[picks.randrange(19)] ^= 1 + n
        right[picks.randrange(21, 40)] ^= 1 + n
        rows.append((7, n, n, 0, bytes(left), bytes(right)))
    windows = Counter(row[4][19 - d :] + row[5][: 40 - d] for row in rows for d in range(20))
    expected = {}
    for row in rows:
        shared = [d for d in range(20) if windows[row[4][19 - d :] + row[5][: 40 - d]] > 1]
        if shared:
            expected[row[1]] = (min(shared), max(shared))
    bodies = spark.createDataFrame(rows, "head long, one long, two long, after long, left binary, right binary")
    found = [(r["one"], (r["near"], r["far"])) for r in method(bodies, rule).collect()]
    assert len(found) == len(expected) > 20 and dict(found) == expected


@pytest.mark.parametrize("rule", [Repeats(40, 20, 64, 2000), Repeats(40, 20, 1000, 3)])
def test_without_repeats(spark, docs, rule):
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 120))) for _ in range(12)]
    rows = []
    for n in range(100):
        text = ""
        for _ in range(rng.randint(0, 4)):
            passage, start = rng.choice(passages), rng.randint(0, 20)
            text += passage[start : rng.randint(start, len(passage))] + "".join(rng.choice("xyzé") for _ in range(rng.randint(0, 30)))
        rows.append((n, text))
    rows += [(200, None), (201, "ab" * 60), (202, "q" * 39), (203, rows[3][1]), (3, rows[3][1]), (None, "z" * 45)]
    seen = Counter(data[p : p + 40] for _, text in rows for data in [(text or "").encode()] for p in range(len(data) - 39))
    expected = []
    for n, text in rows:
        data = (text or "").encode()
        covered = {p + k for p in range(len(data) - 39) if seen[data[p : p + 40]] > 1 for k in range(40)}
        kept = bytes(x for p, x in enumerate(data) if p not in covered)
        expected.append((n, len(data), len(covered), sum(p - 1 not in covered for p in covered), hashlib.sha256(kept).hexdigest()))
    found = [tuple(r)[:5] for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert without_repeats(docs).count() == len(ROWS)


def test_html(spark):
    text = lambda html: main_text(parse(html))
    assert text("<body><nav>m</nav><article><h1>T &amp; U</h1><p>a <b>b<br>c<p>d&nbsp; e<div class='ad x'>no</div></article><footer>f") == "T & U\n\na b c\n\nd e"
    assert text("<ul><li>1<li>2</ul><script>if (a<b) '</p>'</script><form>q</form>") == "1\n\n2"
    assert text("") == "" and text("<" * 50) == "<" * 50 and text("<div>" * 5000 + "x") == "x"
    pages = [(n, f"http://h.org/{n}", f"<body><div class=site>Same words</div><div class=body><p>text {n}</p></div>") for n in range(6)]
    pages += [(10, None, "<div class=site>Same words</div>"), (11, "http://h.org", None), (11, "http://h.org", None)]
    rows = {r.page_id: r for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [rows[n].text for n in (0, 5, 10, 11)] == ["text 0", "text 5", "Same words", ""] and rows[0].n_chars == 6
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_templates_without_names(spark):
    block = "<div>Box</div><ul><li>One<li>Two</ul><section><p>S</section><table><tr><td>T</table>"
    page = lambda n, more: f"<body><section><article>Teaser</article></section><article><h1>H{n}</h1>{more}<p>Shared</p><p>text {n}</p></article>"
    # Four of forty pages have the blocks; two others have one of them at another place.
    pages = [(n, f"http://h.org/{n}", page(n, block if n < 4 else "<blockquote><div>Box</div></blockquote>" if n < 6 else "")) for n in range(40)]
    rows = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert rows == {n: "\n\n".join([f"H{n}", *(["Box"] if n in (4, 5) else []), "Shared", f"text {n}"]) for n in range(40)}


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_token_counts(spark, docs, rule):
    rows = spark.createDataFrame([(1, "one two\n\n  three é日本\nfour\n"), (2, None), (3, ""), (4, "<|endoftext|>")], "doc_id long, text string")
    found = {r.doc_id: r for r in token_counts(rows, rule=rule).collect()}
    text = "one two\n\n  three é日本\nfour\n"
    assert [(x.start, x.end) for x in found[1].sections] == [(0, 8), (8, 9), (9, 21), (21, 26)]
    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as file:
        coder, _ = encoding(file.read())
    place, counts, starts = 0, Counter(), [0, 8, 9]
    data = text.encode()
    bounds = [0] + [n + 1 for n, c in enumerate(data) if c == 10]
    for token in coder.encode_ordinary(text):
        end = place + len(coder.decode_single_token_bytes(token))
        overlap = [min(end, b) - max(place, a) for a, b in zip(bounds, bounds[1:])]  # noqa: B905
        hit = [n for n, x in enumerate(overlap) if x > 0]
        counts[{"first": hit[0], "last": hit[-1], "most": overlap.index(max(overlap))}[rule]] += 1
        place = end
    assert [x.tokens for x in found[1].sections] == [counts[n] for n in range(4)] and starts
    assert found[1].n_tokens == sum(counts.values()) and found[2].n_tokens == found[3].n_tokens == 0 and found[4].n_tokens > 1
    assert token_counts(docs).count() == len(ROWS)
