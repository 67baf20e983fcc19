"""Every operator against a brute-force version, on odd rows, on an empty
table, and on the small tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from repforge.llm import (licenses, ngram_join, packing, quality, revisits, sentencepieces, toxicity, trie_dedup, walks,
                          wrappers)
from repforge.llm.common import table
from tests.llm.conftest import frame, odd_rows

UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SP = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["odd", "nothing", "table"])
def docs(request, spark, sf_small):
    if request.param == "table":
        return table(spark, sf_small, "documents")
    return request.getfixturevalue(request.param)


def counted(rows):
    return Counter(map(tuple, rows))


def test_license_places(docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    want = []
    for doc, text in rows_of(docs):
        words = word.findall((text or "").translate(UP))
        places = [(i, label) for p, label in phrases.items() for i in range(len(words))
                  if words[i: i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        want.append((doc, len(words), len(places), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted({x for _, x in places}))))
    got = licenses.license_digest(licenses.license_spans(docs)).collect()
    assert counted(r[:6] for r in got) == counted(want)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1)


def test_license_edits_within_bounds():
    for n in licenses.NOTICES:
        assert [s for _, s in licenses.seeds_of(n.body, n.edits)] and "".join(
            s for _, s in licenses.seeds_of(n.body, n.edits)) == n.body
        for at in range(3, len(n.body) - 3, 5):
            if n.edits and n.body[at] != " ":
                _, spans = licenses.spans_of("x " + n.body[:at] + "q" + n.body[at + 1:] + n.tail + " y")
                assert any(s["label"] == n.label and s["edits"] == 1 for s in spans), (n, at)
    _, spans = licenses.spans_of("Apache License, Version 1.1; cc by nd; under the mit")
    assert spans == []


def test_trie_owners(docs):
    groups = defaultdict(list)
    for doc, text in rows_of(docs):
        groups[text or ""].append(doc)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    for budget in (trie_dedup.TRIE_BYTES, 50_000):  # the small one spills subtrees
        assert counted(trie_dedup.dedup(docs, "largest", trie_bytes=budget).collect()) == counted(want)


def test_trie_spills_texts_that_begin_alike(spark):
    """1,000 texts of one length behind a common beginning, at a small budget."""
    begin = "<p>" * 300
    rows = [(i, f"{begin}{i % 900:05d}{'x' * 100}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = trie_dedup.owners(docs, "largest", trie_bytes=10_000).collect()
    assert counted((r.keep_id, r.group_size) for r in got) == counted(
        (max(i, i + 900 if i < 100 else i), 2 if i < 100 else 1) for i in range(900))
    batch = pa.record_batch({"bytes": [t.encode() for _, t in rows], "owner": [i for i, _ in rows],
                             "rows": [1] * 1000})
    out = [(r["spilled"], r["bytes"]) for b in trie_dedup._insert(True, 10_000, 1)([batch]) for r in b.to_pylist()]
    assert sum(s for s, _ in out) > 500
    assert sum(len(set(t[-105:])) and len(t) - len(begin) for s, t in out if not s) < 10_000


def test_trie_keeps_prefixes_apart():
    trie = trie_dedup.Trie(False, unit=2)
    for i, t in enumerate([b"abc", b"ab", b"abd", b"", b"abc", b"b", b"a"]):
        trie.insert(t, i, 1)
    assert sorted(trie.records()) == [(b"", 3, 1), (b"a", 6, 1), (b"ab", 1, 1), (b"abc", 0, 2), (b"abd", 2, 1),
                                      (b"b", 5, 1)]
    assert sorted(trie.take_subtree(b"ab")) == [(b"ab", 1, 1), (b"abc", 0, 2), (b"abd", 2, 1)]
    assert trie.take_subtree(b"a") == [(b"a", 6, 1)]
    assert sorted(trie.records()) == [(b"", 3, 1), (b"b", 5, 1)]


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
        sets.append(frozenset(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in holders[g]).items():
            if 100 * both >= 80 * len(s | sets[j]):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def test_ngram_components(docs):
    assert counted(ngram_join.joined(docs).collect()) == counted(brute_components(rows_of(docs)))


def test_ngram_families_around_the_threshold(spark):
    """Families whose members drift, so that links run over members that are
    no leaders, and a passage that unrelated texts share."""
    rng = np.random.default_rng(3)
    rows, passage = [], " ".join(f"p{i}" for i in range(60))
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(int(rng.integers(40, 120)))]
        for _ in range(14):
            text = list(base)
            for _ in range(int(rng.integers(0, 5))):
                text[int(rng.integers(len(text)))] = f"x{rng.integers(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
            if rng.random() < 0.4:
                base = text
    rows += [(2000 + i, passage + " " + " ".join(f"u{i}x{k}" for k in range(int(rng.integers(2, 40))))) for i in range(60)]
    got = counted(ngram_join.joined(frame(spark, rows)).collect())
    assert got == counted(brute_components(rows))


def test_edit_fingerprints(docs):
    rows = sorted(((-2**63 if d is None else d, t or "", d) for d, t in rows_of(docs)), key=lambda r: r[:2])
    want = []
    for i, (_, text, doc) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = walks.beside_next(docs).collect()
    assert counted(r[:3] for r in got) == counted(want)
    prints = dict(zip([r[1] for r in rows], walks.as_text(walks.walker().fingerprints([r[1] for r in rows]))))
    assert {r.fingerprint for r in got} == set(prints.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_walk_matches_one_by_one():
    """The lockstep walk equals a walk step by step over one text."""
    w = walks.walker()
    for text in ("abc", "hello world " * 9, "é漢" * 40):
        code = (np.frombuffer(text.encode("utf-32-le"), np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
        steps = [0]
        for c in code:
            steps.append(steps[-1] + int(w.stay[(steps[-1] % walks.PERIOD) * 256 + int(c)]))
        slot = 0  # a slot of the first walk
        record = int(np.searchsorted(w.records[slot], steps[-1], side="left")) - 1
        value = np.array([record + 1], np.uint64) * w.mix[0]
        for k in range(walks.SYMBOLS):
            here = int(w.records[slot][record]) + walks.STRIDE * k
            at = int(np.searchsorted(steps, here, side="right")) - 1
            symbol = np.uint64(int(code[at]) + 1 if here < steps[-1] else 0)
            value ^= value >> np.uint64(29)
            value = (value + symbol) * w.mix[2 + k]
        value ^= value >> np.uint64(32)
        value *= w.mix[0]
        assert w.fingerprints([text])[0, slot] == int(value[0] >> np.uint64(48))


def test_edit_distance_and_near_leaders(spark):
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("abc"), int(rng.integers(0, 9)))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            left, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                left, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, left + (x != y))
        assert walks.edit_distance(a, b) == row[-1]
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(i, base if i < 4 else base[:700] + "#" * i + base[700:]) for i in range(8)] + [(20, "other " * 90)]
    got = dict(walks.near_leaders(frame(spark, rows)).collect())
    assert got[3] == 0 and got[20] == 20 and sum(got[i] == 0 for i in range(8)) >= 7


def test_sentencepiece_ids(docs):
    import sentencepiece
    processor = sentencepiece.SentencePieceProcessor(model_file=SP)
    want = []
    for doc, text in rows_of(docs):
        ids = processor.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(processor.decode(ids).encode()).hexdigest(), True))
    assert counted(sentencepieces.encoded(docs, SP).collect()) == counted(want)


def test_weaker_notices_beside_a_better_one():
    notice = licenses.Notice("mit", "under the mit license")
    for text in ("under thx mitt license foo under the mitt license", "under thx mit license under the mit license",
                 "under the mit license under thx mit license", "undr the mitt license under the mitt license under thx mt license"):
        got = [text[s:e] for _, s, e, _ in licenses.scan(text, (notice,))]
        assert got == ["un" + t.strip().removesuffix(" foo") for t in text.split("un")[1:]], text


def test_sentencepiece_rows_are_the_agendas(monkeypatch):
    words = sentencepieces.encode_texts(["other words"], SP)[0]
    monkeypatch.setattr(sentencepieces, "encode_texts", lambda texts, path: [words for _ in texts])
    ids, decoded, agrees = sentencepieces.encode_checked(["some text", "other words"], SP)
    assert [x.tolist() for x in ids] == [words.tolist()] * 2
    assert decoded == ["other words"] * 2 and agrees == [False, True]


def test_packing_whole(docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    got = packing.pack(docs, BPE).collect()
    left = Counter()
    for doc, text in rows_of(docs):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 2048):
            left[doc, s, len(ids[s: s + 2048]), zlib.crc32(ids[s: s + 2048].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == left
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 2048
    if len(got) > 100:
        assert sum(r.length for r in got) >= 0.97 * 2048 * len(sequences)


def test_ranks_encode_as_the_library():
    """Words of every kind, odd characters, special strings; a file of another
    kind has no ranks."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(12)
    letters = "aehinorst'.,-0123 éßñЖд漢字かな한½²\x85‍😀𝔘ᲀꟂ\n\t"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 12))) for _ in range(20_000)]
    words += ["don't", "''" + "'s", "x" * 3000, "\x00\x1c\x7f"]
    _, table = packing._tokenizer(path)
    got = table.encode(words)
    assert table.encode([("a<|endoftext|>b",), ("a",)]) == [e.ids for e in library.encode_batch(["a<|endoftext|>b", "a"])]
    assert got == [e.ids for e in library.encode_batch([" " + w for w in words], add_special_tokens=False)]
    assert packing.rank_encoder(path) is not None
    assert packing.rank_encoder(public_tokenizers.path("word_bpe_49k.json")) is None


def test_token_chunks_at_odd_blanks():
    from tokenizers import Tokenizer
    tokenizer, rng = Tokenizer.from_file(BPE), np.random.default_rng(2)
    texts = ["".join(rng.choice(list("ab \n\t \x1cé'1.—漢"), int(rng.integers(0, 25)))) for _ in range(3000)]
    texts += ["a <|endoftext|> b\n <|endoftext|>", "   ", " a", "a  "]
    for text, ids in zip(texts, packing.token_ids(texts, BPE, 1)):
        assert [*tokenizer.encode(text, add_special_tokens=False).ids, 1] == ids.tolist(), repr(text)


def test_patterns_hold_the_demand():
    rng = np.random.default_rng(4)
    for _ in range(5):
        histogram = {int(c): int(rng.integers(1, 60)) for c in rng.choice(np.arange(1, 257), 20, replace=False)}
        patterns = packing.patterns_for(histogram)
        held = Counter()
        for pattern, times in patterns:
            assert sum(c * n for c, n in pattern.items()) <= 256
            for c, n in pattern.items():
                held[c] += n * times
        assert all(held[c] >= n for c, n in histogram.items())
        sizes = np.array(sorted(histogram))
        lp = sum(x for _, x in packing.column_generation(sizes, np.array([histogram[c] for c in sizes], float), 256))
        assert sum(t for _, t in patterns) <= lp + len(histogram)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held(doc, modulus, remainder):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == remainder


@pytest.mark.parametrize("operator,modulus,remainder", [(quality, 4, 2), (toxicity, 5, 0)])
def test_classifiers_on_odd_rows(spark, odd, nothing, operator, modulus, remainder):
    labels = labels_of(spark, [(i, i % 2, int(i in (3, 5))) for i in range(7)] + [(20, 1, None), (None, 1, 1), (0, 1, 0)])
    got = operator.scored(odd, labels).collect()
    assert counted((r.doc_id, r.held_out) for r in got) == counted((d, held(d, modulus, remainder))
                                                                  for d, _ in odd_rows())
    assert all(0 <= r.score <= 1 for r in got)
    assert operator.scored(nothing, labels).count() == 0
    assert operator.scored(odd, labels.limit(0)).count() == len(odd_rows())


@pytest.mark.parametrize("operator,label,modulus,remainder", [(quality, "quality", 4, 2), (toxicity, "toxic", 5, 0)])
def test_classifiers_held_out(spark, operator, label, modulus, remainder):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r[label] for r in table(spark, sf, "labels").collect()}
    got = operator.scored(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    judged = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in judged]) > 0.9
    assert len(got) == 1000


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = frame(spark, [(i, f"good words here {i}" if i % 2 else "BAD!! BAD!! BAD!!") for i in range(60)])
    label = lambda flip: labels_of(spark, [
        (i, (i % 2) ^ (flip and held(i, 4, 2)), 0) for i in range(60)])
    a, b = (sorted(quality.scored(docs, label(f)).collect()) for f in (False, True))
    assert a == b


def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(8)
    evidence, move = rng.normal(size=6), rng.normal(size=(2, 2))
    weight = {}
    for tags in np.ndindex(*(2,) * 6):
        weight[tags] = np.exp(sum(evidence[i] * t for i, t in enumerate(tags))
                              + sum(move[a, b] for a, b in zip(tags, tags[1:])))
    want = [sum(v for k, v in weight.items() if k[i]) / sum(weight.values()) for i in range(6)]
    got = toxicity.marginals([evidence, evidence[:0], evidence[:3]], move)
    assert np.allclose(got[0], want) and len(got[1]) == 0 and len(got[2]) == 3


def test_toxic_spans_offsets(spark):
    train = [(f"plain words number {i} go on" + (" utter moron there" if i % 3 == 0 else ""), int(i % 3 == 0))
             for i in range(90)]
    import pickle
    model = pickle.dumps(toxicity.train([t for t, _ in train], [y for _, y in train]))
    text = "Somewhere, é: MORON! go"
    rows = toxicity.toxic_spans(frame(spark, [(1, text), (2, None), (3, "plain words go on")]), model).collect()
    spans = {r.doc_id: [(s.start, s.end, s.text) for s in r.spans] for r in rows}
    assert spans == {1: [(text.index("MORON"), text.index("MORON") + 5, "MORON")], 2: [], 3: []}


PAGE = ("<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><div class='ad'>Buy now</div>"
        "<article><h1>{0}</h1><p>One &amp; {1}<br>two <b>bo</b>ld<p>three</article>"
        "<div id='comments'><p>first!</p></div><footer>(c) us</footer></body></html>")


def test_wrapped_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(f"Title {i}", "x" * (i % 5 + 1))) for i in range(12)]
    want = {i: f"Title {i} One & {'x' * (i % 5 + 1)} two bold three" for i in range(12)}
    odd = [(100, None, None), (101, "http://h.example/e", ""), (None, "http://h.example/n", "just text"),
           (102, "no url", "<div>" * 3000 + "deep" + "</div>" * 3000), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows + odd],
                                  "page_id long, url string, html string, host string, text string")
    got = wrappers.extracted(pages).collect()
    assert counted((r.page_id, r.url) for r in got) == counted(r[:2] for r in rows + odd)
    found = {r.page_id: r.text for r in got}
    assert {i: found[i] for i in want} == want
    assert found[100] == found[101] == "" and found[102] == "deep" and found[None] == "just text"
    assert all(r.n_chars == len(r.text) for r in got)
    assert wrappers.extracted(pages.limit(0)).count() == 0


def test_names_skip_only_as_whole_values(spark):
    htmls = ["<body class='single has-sidebar'><p>a</p><div class=ad>no</div></body>",
             "<div class='content-with-sidebar'><article>a</article></div>",
             "<body><article class='comments-open'>a</article></body>",
             "<body id=widget><div class=sidebar><main class=related>a</main></div></body>",
             "<body><h2 id='related-work'>a</h2><section id='social-policy'>b</section><p class='ad-hoc'>c"
             "<p data-id='ad'>d</p><p id=share>no</p></body>"]
    pages = spark.createDataFrame([(i, f"http://n{i}.example/", h) for i, h in enumerate(htmls)],
                                  "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == {
        0: "a", 1: "a", 2: "a", 3: "a", 4: "a b c d"}


def test_markup_around_and_inside_articles(spark):
    """A form around the page, drawings without an end tag, quotes inside
    unquoted values, slashed raw elements: no article is lost."""
    long = "Words of the article " * 20
    htmls = {
        f"<body><form id=aspnetForm><div><h1>a</h1><p>{long}</p></div><nav>menu</nav><input name=q></form></body>":
            f"a {long}",
        f"<body><form><main><p>b</p></main></form><p>{long}</p><form><label>Your name</label></form></body>":
            f"b {long}",
        f"<body><h1>c</h1><p>one <svg class='i'/> two</p><p>{long}</p></body>": f"c one two {long}",
        f"<body><div><svg><path d='M0'></div><p>d</p><p>{long}</p></body>": f"d {long}",
        f"<body><p><a title=it's href=x>e</a> f</p><p>don't</p><p>{long}</p></body>": f"e f don't {long}",
        f"<body><p>g</p><iframe src=x /><p>{long}</p><iframe src=y></iframe></body>": f"g {long}",
        f"<body><p data-x='>' title=\"a>b\">h</p><script>if (a<b) '</p>'</script><p>{long}</p></body>": f"h {long}",
        f"<body><header><article><h1>i</h1></article><p>{long}</p></header><aside><article>no</article></aside></body>":
            f"i {long}",
    }
    rows = [(i, f"http://m{i}.example/", h) for i, h in enumerate(htmls)]
    rows += [(100 + i, f"http://many.example/{i}", f"<body><form id=f><div>Top</div><div><p>{long}{i}</p></div></form>")
             for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extracted(pages).collect()}
    want = {i: w for i, w in enumerate(htmls.values())} | {100 + i: f"{long}{i}" for i in range(12)}
    assert got == {i: " ".join(w.split()) for i, w in want.items()}


def test_unclosed_quotes_take_linear_time():
    import time
    start = time.time()
    wrappers.parse("<body><p>" + "<a b='c' d=\"" * 20_000)
    assert time.time() - start < 10
    assert wrappers.text_of(wrappers.parse("<p>a</p><!-- b <i> c"), set()) == "a"
    assert wrappers.text_of(wrappers.parse("<p>a</p> d <!-- b"), set()) == "a d"


def test_constant_nodes_become_template(spark):
    rows = [(i, "http://t.example/x", f"<body><main><h1>Story {i}</h1><p>Share this story now</p>"
                                      f"<p>Body of {i} {'z' * i}</p></main></body>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == {
        i: f"Story {i} Body of {i} {'z' * i}".strip() for i in range(20)}


def test_template_with_line_breaks_and_copies(spark):
    def page(i):
        return (f"<body>\n<main>\n<h1>Story {i}</h1>\n<nav><a>Home</a> <a>News</a></nav>\n<p>Share this story now</p>\n"
                f"<p>Body of <b>{i}</b> <i>{'z' * i}</i></p>\n<p>Read more <a>here</a></p>\n</main>\n</body>")
    copy = "<body>\n<p>Same text</p>\n<p>on all pages</p>\n</body>"
    rows = [(i, "http://t.example/x", page(i % 20)) for i in range(400)]
    rows += [(1000 + i, "http://c.example/x", copy) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extracted(pages).collect()}
    assert got == {i: f"Story {i % 20} Body of {i % 20} {'z' * (i % 20)}".strip() for i in range(400)} | {
        1000 + i: "Same text on all pages" for i in range(20)}


def test_slots_by_layout_hold_all_varying_text(spark):
    def words(i, n):
        return " ".join(f"w{i}x{k}" for k in range(n))
    rows, want = [], {}

    def add(page_id, host, html, text):
        rows.append((page_id, f"http://{host}.example/{page_id}", html))
        want[page_id] = text
    for i in range(20):  # the article in two blocks
        add(i, "two", f"<body><div><p>{words(i, 40)}</p></div><div><p>{words(-i - 1, 10)}</p></div></body>",
            f"{words(i, 40)} {words(-i - 1, 10)}")
    add(99, "lay", "<body><p>not found</p></body>", "not found")  # not the reference of the others
    for i in range(100, 140):
        add(i, "lay", f"<body><div class=top><div>Our motto</div></div><div class=story><p>{words(i, 40)}</p></div></body>",
            words(i, 40))
    for i in range(140, 160):  # the first block is a teaser here
        add(i, "lay", f"<body><div><p>{words(i, 2)}</p></div><div><div><p>{words(-i, 40)}</p><p>Sign up</p></div></div></body>",
            f"{words(i, 2)} {words(-i, 40)}")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == want


def test_text_after_deep_nests():
    def nested(tag, text, n=300):
        return f"<{tag}>" * n + text + f"</{tag}>" * n
    for inner, want in ((nested("div", "deep"), "deep"), ("<p>" + "<font>" * 300 + "deep", "deep"),
                        ("<div>" * 250 + "deep<nav><ul><li>menu</ul></nav><p class=ad>x</p>" + "</div>" * 250, "deep"),
                        (nested("div", "a" + nested("span", "b") + "c"), "abc")):
        page = wrappers.parse(f"<body><div id=page><div class=story>{inner}<p>rest</p></div><p>end</p></div>out</body>")
        div = page.children[0].children[0]
        story = div.children[0]
        assert wrappers.text_of(story, set()) == f"{want} rest"
        assert wrappers.text_of(div, set()) == f"{want} rest end"
        assert wrappers.text_of(page, set()) == f"{want} rest end out"
        mirror = wrappers.unpack_tree(json.dumps(wrappers.pack_tree(page)))
        assert len(wrappers.aligned(mirror, page)) == wrappers._size(page)


def test_tables_pages(spark, sf_small):
    import html as h
    pages = table(spark, sf_small, "pages")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", inner))
        want[r.page_id] = " ".join(h.unescape(inner).split())
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == want


def test_tree_matching_is_the_largest_alignment():
    a = wrappers.parse("<div><p>x</p><ul><li>1<li>2</ul><p>y</p></div>")
    b = wrappers.parse("<div><p>q</p><p>r</p><ul><li>1</ul></div>")
    # root, div, p + text, ul, li + text
    assert wrappers.match(a, b) == 7
    assert len(wrappers.aligned(a, b)) == 7


def brute_revisits(records, key_of):
    out = []
    for r in records:
        if r["status"] != 304:
            continue
        key = key_of[r["url"]]
        own = {k.lower(): v for k, v in (r["headers"] or {}).items()}
        earlier = [s for s in records if s["status"] == 200 and key and key_of[s["url"]] == key and s["ts"] is not None
                   and r["ts"] is not None and s["ts"] < r["ts"]]
        if not earlier:
            out.append((r["record_id"], None, "no_earlier", own, None))
            continue
        s = max(earlier, key=lambda s: (s["ts"], s["record_id"]))
        theirs = {k.lower(): v for k, v in (s["headers"] or {}).items()}
        bare = lambda h: re.sub("^W/", "", h["etag"]) if h.get("etag") else None
        outcome = "unverified"
        if bare(theirs) and bare(own):
            outcome = "resolved" if bare(theirs) == bare(own) else "mismatch"
        elif theirs.get("last-modified") and own.get("last-modified"):
            outcome = "resolved" if theirs["last-modified"] == own["last-modified"] else "mismatch"
        merged = {**theirs, **{k: v for k, v in own.items() if k in revisits.PERMITTED}}
        sure = outcome == "resolved"
        out.append((r["record_id"], s["record_id"], outcome, merged if sure else own, s["digest"] if sure else None))
    return out


def test_canonical_urls(spark):
    pairs = {"HTTP://WWW.A.example:80/x/?b=2&utm_source=q&a=1#f": "a.example/x?a=1&b=2",
             "https://a.example/x?a=1&b=2&ref=z": "a.example/x?a=1&b=2", "https://a.example": "a.example",
             "https://a.example:8080/": "a.example:8080", "not a url": None, "": None, None: None}
    df = spark.createDataFrame([(u,) for u in pairs], "url string")
    got = {r.url: r.key for r in df.select("url", revisits.canonical_url(df["url"]).alias("key")).collect()}
    assert got == pairs


@pytest.mark.parametrize("bucket", [10_000, 3])
def test_revisits_by_brute_force(spark, monkeypatch, bucket):
    """One URL holds most records; buckets of three times carry over."""
    monkeypatch.setattr(revisits, "BUCKET_ROWS", bucket)
    rng = np.random.default_rng(6)
    urls = ["http://hot.example/a", "https://www.hot.example/a/", "http://b.example/", None, "junk"]
    records = []
    for i in range(300):
        status = int(rng.choice([200, 304, 304, 404]))
        headers = {"ETag": f'{"W/" if rng.random() < .3 else ""}"{rng.integers(3)}"' if rng.random() < .7 else None,
                   "Last-Modified": f"d{rng.integers(3)}" if rng.random() < .7 else None,
                   "Content-Type": "x", "date": str(i), "CACHE-control": "c" if status == 304 else "s"}
        records.append({"record_id": i, "url": urls[int(rng.choice(5, p=[.5, .25, .1, .1, .05]))],
                        "ts": None if rng.random() < .05 else int(rng.integers(-50, 50)), "status": status,
                        "headers": {k: v for k, v in headers.items() if v} if rng.random() < .95 else None,
                        "digest": f"p{i}" if status == 200 else None})
    records += [dict(r) for r in records if r["status"] == 304][:5]  # repeated rows
    records.append({"record_id": 999, "url": urls[0], "ts": 2**62, "status": 304, "headers": {}, "digest": None})
    key_of = dict(zip(urls, ["hot.example/a", "hot.example/a", "b.example", None, None]))
    df = spark.createDataFrame([(*r.values(), "extra") for r in records], revisits.RECORDS + ", source_id string")
    got = [(r.record_id, r.source_id, r.outcome, r.headers, r.digest) for r in revisits.resolved(df).collect()]
    freeze = lambda rows: Counter((*r[:3], tuple(sorted(r[3].items())), r[4]) for r in rows)
    assert freeze(got) == freeze(brute_revisits(records, key_of))
    assert revisits.resolved(df.limit(0)).count() == 0


def test_crawl_covers_every_page(spark, sf_small):
    pages = table(spark, sf_small, "pages")
    n = pages.count()
    crawl = revisits.crawl_of(pages)
    assert crawl.count() == 4 * n - len([r for r in pages.collect() if r.page_id % 13 == 0])
    found = revisits.resolved(crawl)
    assert found.count() == crawl.filter("status = 304").count()
    assert {r.outcome for r in found.select("outcome").distinct().collect()} >= {"resolved", "mismatch", "no_earlier"}


def test_parity_sketch_bounds_the_overlap():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 400, 3000):
        for share in (0.0, 0.3, 0.8, 0.95, 1.0):
            x = np.unique(rng.integers(0, 2**64, n, np.uint64))
            y = np.unique(np.concatenate([x[:int(share * len(x))], rng.integers(0, 2**64, n // 3, np.uint64)]))
            differing = int(np.bitwise_count(
                ngram_join.sketch_of(x).view(np.uint64) ^ ngram_join.sketch_of(y).view(np.uint64)).sum())
            assert len(np.intersect1d(x, y)) <= (len(x) + len(y) - differing) // 2


def test_merged_components_equal_components_of_all_edges(spark):
    rng = np.random.default_rng(4)
    scratch = ngram_join.Scratch(spark)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2)) if a != b]
    as_frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    whole = ngram_join.components(scratch, as_frame(edges)).collect()
    first = ngram_join.components(scratch, as_frame(edges[:90]))
    after = ngram_join.merged(scratch, first, as_frame(edges[90:])).collect()
    assert sorted(whole) == sorted(after)
    assert ngram_join.components(scratch, as_frame([])).count() == 0


def test_lockstep_agendas_equal_the_heap():
    import sentencepiece
    agenda = sentencepieces.Agenda(sentencepiece.SentencePieceProcessor(model_file=SP))
    rnd = random.Random(2)
    words = ["", "▁", "▁" + "a" * 200, "▁é", "🙂", "▁aaaaaaa"]
    words += ["▁" + "".join(rnd.choice("etaoin shrdluéß漢🙂\x00\n'") for _ in range(rnd.randint(0, 70))).replace(" ", "▁")
              for _ in range(3000)]
    assert agenda.encode_words(words) == [agenda.encode(w) for w in words]
    assert agenda.encode_words([]) == []
