"""The training-data operators on small fixtures: brute force, round trips, odd rows."""

import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import binary, decontam, extraction, language, licenses, mixing, neardup, quality, queries, sharding, sql, urls
from corpusloom.llm.common import word_memo
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LONG = "alpha beta gamma delta " * 4000
ODD = [
    (1, "plain words in a row, enough of them to be a text of ten words", "en"),
    (1, "plain words in a row, enough of them to be a text of ten words", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \n\t ", None),
    (None, "a row without an id", "en"),
    (5, "12 34 !!", "de"),
    (6, LONG, "en"),
    (7, "MIT License. Ünïcode <|endoftext|> x  y\u00a0z", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string")
    extra = {c: F.lit("x") for c in ("_words", "_key", "shard", "component", "band", "_p", "_leak2", "rate", "label")}
    return rows.withColumns(extra | {"source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint")})


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_jump_hash_moves_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    before = sharding.jump_hash(keys, 1)
    assert (before == 0).all()
    for n in range(2, 20):
        after = sharding.jump_hash(keys, n)
        assert ((after == before) | (after == n - 1)).all()
        assert np.bincount(after, minlength=n).min() > 5000 / n * 0.6
        before = after


def test_shards_of_odd_rows(odd):
    rows = sharding.shard_documents(odd, shards=3).collect()
    assert len(rows) == len(ODD)
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in ODD)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    assert all(r.grown_shard in (r.shard, 3) for r in rows)


def jump(key, shards):
    """Jump consistent hashing of one key."""
    key, at, ahead = key % 2**64, -1, 0
    while ahead < shards:
        at, key = ahead, (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_shards_are_those_of_the_loop():
    keys = [0, 1, -1, 2**53 + 1, 2**63 - 1, -(2**63), *range(500)]
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(np.array(keys, np.int64), n).tolist() == [jump(k, n) for k in keys]


LARGE = [2**53 + 1, 2**53 + 3, -(2**62) - 1]


def test_a_null_id_leaves_others_alone(spark):
    """In one batch with a null, ids that a float cannot hold stay as they are."""
    texts = ["some words to share here", "some words to share here", "other words"]
    rows = [*zip(LARGE, texts), (None, "a null id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert {r.doc_id: r.shard for r in sharding.shard_documents(df).collect()} == {k: jump(k, 16) for k in LARGE} | {None: jump(0, 16)}
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, neardup.Settings(width=2)).collect()}
    assert got == {LARGE[0]: LARGE[0], LARGE[1]: LARGE[0], LARGE[2]: LARGE[2], None: None}
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(df.where("doc_id is not null")).collect()) == sorted((LARGE[0], LARGE[2]))


def test_what_counts_as_a_letter():
    assert not any(map(language.has_letter, [None, "", "²", "½ Ⅷ ①", "12 _ !", "१२"]))
    assert all(map(language.has_letter, ["a", "1 é", "字", "_ß_"]))


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, r in enumerate(runs) if runs.count(r) > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in quality.SYMBOLS for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rnd = random.Random(3)
    texts = [None, "", " \v\f ", "a b c d", "x y z u v x y z u v w", "é\né\n\né b#", "a a a a a a a"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) + "\n#" for _ in range(30)]
    got = {r.doc_id: r for r in quality.judge_documents(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measured(t), t
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_odd_rows_policies_and_ablation(odd):
    rows = quality.judge_documents(odd)
    assert rows.count() == len(ODD)
    policy = quality.POLICIES["clean-2"]
    bits = [r.failures for r in rows.collect()]
    for r in quality.ablations(rows, policy).collect():
        bit = 1 << list(quality.RULES).index(r.rule)
        assert r.fails == sum(b & bit != 0 for b in bits)
        assert r.kept_without == sum(b == bit for b in bits)
    assert quality.judge_documents(odd.limit(0)).count() == 0


PAGE = (
    '<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><a href="/">Home</a><a>About</a></nav>'
    '<div class="ad">Buy now, buy a lot of things today</div><article><h1>Head &amp; more</h1><p>First <b>bold</b>\n text.'
    '<p>Second</article><div id="comments"><p>I disagree with every word of this</p></div><footer>&copy; x</footer></body></html>'
)


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "Head & more\n\nFirst bold text.\n\nSecond"),
        (PAGE.replace("article>", "div>"), "Head & more\n\nFirst bold text.\n\nSecond"),
        (None, ""),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("<p>short", "short"),
        ("<p>" + "long text " * 30 + "</p><form><p>name</p></form><p>cut of</p><p a=\"", ("long text " * 30).strip() + "\n\ncut of"),
    ],
)
def test_main_text(page, text):
    assert extraction.main_text(page).startswith(text) and len(extraction.main_text(page)) <= len(text) + 2


def test_lengths_choose_the_text_where_articles_are_marked():
    menu = '<ul class="menu"><li><a>x</a><li><a>y</a><li><a>z</a></ul>' * 3
    page = f"<body><div><p>{'real text ' * 20}</p></div>{menu}<article><p>{'marked text ' * 20}</p>{menu}<p>short</p></article></body>"
    lines = extraction.lines_of(page)
    assert [lines[i][0][:4] for i in sorted(extraction.chosen_lines(lines)) if lines[i][0]][:2] == ["real", "mark"]
    assert extraction.main_text(page) == "\n\n".join([("real text " * 20).strip(), ("marked text " * 20).strip(), "short"])


PARAGRAPH = ("a long paragraph of the text " * 5).strip()
MENU = '<ul class="menu"><li><a href="/a">one</a><li><a href="/b">two</a><li><a href="/c">three</a><li>four</ul>'


@pytest.mark.parametrize(
    "page, blocks",
    [
        (f"<div><div><p>A</p></div><div><p>B</p></div><div><div><p>{PARAGRAPH}</p></div></div></div>", ["A", "B", PARAGRAPH]),
        (f"<div><h1>Title</h1>{MENU}<div><p>Short</p></div>{MENU}<p>{PARAGRAPH}</p>{MENU}<p>End</p></div>", ["Title", "Short", PARAGRAPH, "End"]),
        (f"<body><div><p>{PARAGRAPH}</p><p>So</p></div>{MENU}<div>far away</div></body>", [PARAGRAPH, "So"]),
        (f"<div><h1><a>Title</a></h1><p>{PARAGRAPH}</p><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul><p>End</p></div>", ["Title", PARAGRAPH, "x", "y", "z", "End"]),
        (f'<div><p class="notice">Beware<p>{PARAGRAPH}<p>End</div>', [PARAGRAPH, "End"]),
        (f'<div><p class="notice">Beware</div><p>{PARAGRAPH}<p>End', [PARAGRAPH, "End"]),
        (f'<article><p>{PARAGRAPH}<p class="notice">Beware</article><div><p>{PARAGRAPH} too</p></div>', [PARAGRAPH, PARAGRAPH + " too"]),
        (f'<ul><li class="menu">Beware<ul><li>in it</ul>more<li>{PARAGRAPH}<li>End</ul>', [PARAGRAPH, "End"]),
        (f'<dl><dt class="ad">Beware<dd>{PARAGRAPH}<dt>End</dl>', [PARAGRAPH, "End"]),
        (f'<table><tr><td class="ad">Beware<td>{PARAGRAPH}<tr><td>End</table>', [PARAGRAPH, "End"]),
        (f'<p>{PARAGRAPH} <span class="ad">Buy <span>now</span></span></p><p><a class="share">Share</p><p>End', [PARAGRAPH, "End"]),
        (f'<div class="ad"><div>Buy</div><p>now</div><p>{PARAGRAPH}</p>', [PARAGRAPH]),
        (f"<p><a>open link<p>{PARAGRAPH}</p><p>End", [PARAGRAPH, "End"]),
    ],
)
def test_no_block_of_the_text_is_lost(page, blocks):
    assert extraction.main_text(page) == "\n\n".join(blocks)


def test_pages_of_any_kind(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "", "<div>" * 3000 + "deep"), (4, "x", "<p>" + "y " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = extraction.extract_pages(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)


def test_licenses():
    def found(t):
        return licenses.scan(t, licenses.PHRASES, licenses.TEMPLATES)

    assert found(None) == (0, 0, None, None, "", "", 0.0)
    assert found("x MIT-license, mit LICENSE") == (5, 2, 1, 3, "mit", "mit", 0.5)
    assert found("This fine work is licensed under the GNU Affero General Public License version 3.")[4:] == ("gpl", "gpl,gpl-notice", 1.0)
    assert found("Released under terms of the MIT License")[5] == "mit"  # half an optional part is not allowed
    assert found("Released under the terms of the MIT License")[5] == "mit,mit-notice"
    assert found("a permitive apache license")[4] == "apache"
    a = licenses.compiled("go {{2}} [[then]] stop")
    assert [a.match(t.split(), 0) for t in (b"go stop", b"go a b then stop", b"go a b c stop", b"go then then then stop")] == [2, 5, 0, 5]


def test_licenses_of_odd_rows(odd):
    rows = licenses.scan_documents(odd).collect()
    assert len(rows) == len(ODD) and sum(r.base_labels == "mit" for r in rows) == 1


def test_urls(spark):
    cases = {
        "HTTP://A.Example.NET/en/x?y": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://sub.example.net/fr/": ("sub.example.net", "/fr/", "net/", "block"),
        "x://example.com/de/1#t": ("example.com", "/de/1", "example.com/de/", "block"),
        "x://a.org/fr/1": ("a.org", "/fr/1", "org/fr/", "allow"),
        "x://anet/": ("anet", "/", None, None),
        "no scheme": ("", "", None, "allow"),
        "https://www.casino-bets.example.com/en/5": ("www.casino-bets.example.com", "/en/5", None, "block"),
        "https://www.library.example.com/en/5": ("www.library.example.com", "/en/5", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate([*cases, None, ""])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(7))
    got = {r.page_id: r for r in urls.judge_urls(pages, urls.labelled_urls(spark)).collect()}
    assert len(got) == len(rows) and got[8].host == "" and got[9].verdict == "allow"
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict in (None, got[i].verdict)
    none = urls.labelled_urls(spark).limit(0)
    assert {r.verdict for r in urls.judge_urls(pages, none).collect()} == {"allow", "block"}


def test_token_files(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    got = binary.encode_documents(odd, queries.tokenizer_path()).orderBy("start").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    start = 0
    for r, (_, text, _) in zip(got, order):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert binary.encode_documents(odd.limit(0), queries.tokenizer_path()).count() == 0


def test_encoder_agrees_with_whole_texts():
    encoder = binary.Encoder(queries.tokenizer_path(), limit=20)
    rnd = random.Random(5)
    texts = ["don't it's. a's' x''s 3's", "l'été, d'ß.", "a  b", "\n", " x", "x ", "a \n b", "ĊĠ ĠĊ\nĠ", "ª² ǅx Ωm", "a\tb", "é\u3000y", "日本 語。", "", None]
    parts = ["a", "Foo", "bär", "ɏ", "ɐ", "ÿ", "×", "½", "ё", "'s", "<|endoftext|>", "<|", ".", "!?", "12", " ", "  ", "\n", "\n\n", "\r\n", "\x1c", "\xa0", "e\u0301", "\x00"]
    texts += ["".join(rnd.choice([*parts, " ", " ", "\n"]) for _ in range(rnd.randrange(12))) for _ in range(3000)]
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (1, 40, 1 << 20):
        batch = pa.record_batch({"text": pa.array(texts, pa.string())})
        slices = list(binary.chunks(batch, "text", size))
        assert sum(c.num_rows for c in slices) == len(texts) and (len(slices) > 1) == (size < 1 << 20)
        got = [ids for c in slices for ids in encoder.encode(c.column("text"))]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == want
    assert encoder.encode(pa.array([], pa.string())) == []


def test_grammar_shards_decode_anywhere():
    rng = np.random.default_rng(5)
    ids = [rng.zipf(1.5, n).clip(0, 50_000).astype("<u2").tobytes() for n in (0, 1, 700, 5000)] + [np.full(4001, 7, "<u2").tobytes()] * 3
    payload = binary.pack(np.arange(len(ids)), ids)
    shard = binary.Shard(payload)
    assert len(payload) < sum(map(len, ids))
    for k, raw in enumerate(ids):
        want = [*np.frombuffer(raw, "<u2").tolist(), 0]
        assert shard.document(k).tolist() == want
        for _ in range(20):
            a, b = sorted(rng.integers(0, len(want) + 1, 2))
            assert shard.slice(k, a, b).tolist() == want[a:b]


def test_language(spark):
    rnd = random.Random(4)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "un", "ö"], "cc": ["que", "ñ", "os"]}
    rows = []
    for i in range(240):
        lang = list(syllables)[i % 3]
        rows.append((i, " ".join("".join(rnd.choices(syllables[lang], k=3)) for _ in range(20)), lang if i % 7 else None, lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, truth string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(got[i].lang_pred == truth and 0 <= got[i].score <= 1 for i, _, _, truth in rows)


def test_language_learns_nothing_from_held_out_rows(spark):
    key = F.col("doc_id")
    docs = spark.createDataFrame(
        [(i, ["der hund und die katze", "the dog and the cat"][i % 2] + f" {chr(97 + i % 26)}", ["de", "en"][i % 2]) for i in range(300)],
        "doc_id bigint, text string, lang string",
    )
    changed = docs.withColumns(
        {c: F.when(language.held_out(key), F.lit(v)).otherwise(F.col(c)) for c, v in (("text", "qqq zzz"), ("lang", "xx"))}
    )
    one, two = (language.train(d, ~language.held_out(key), "text", "lang", key) for d in (docs, changed))
    assert one.languages == two.languages and (one.idf == two.idf).all() and (one.weights == two.weights).all()
    assert one.temperature == two.temperature


def test_language_of_odd_rows(odd):
    got = language.identify(odd).collect()
    assert len(got) == len(ODD)
    assert sum(r.lang_pred == "und" and r.score == 0 for r in got) == 4
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.keep_identified(unlabelled).count() == len(ODD) - 4
    assert language.identify(odd.limit(0)).count() == 0


def brute_components(texts, width, percent=80):
    memo = word_memo()
    sets = [set(neardup.shingles(t, width, memo).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root, [len(s) for s in sets]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rnd = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " ", "one", "ONE", "one two", "one two"]
    for _ in range(12):
        base = rnd.choices(vocabulary, k=rnd.choice([8, 40, 120]))
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(8)):
            near = list(base)
            for _ in range(rnd.randrange(1, 6)):
                near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
            texts.append(" ".join(near))
    base = rnd.choices(vocabulary, k=150)
    for i in range(60):  # a large group around the threshold
        near = list(base)
        for _ in range(rnd.randrange(4, 10)):
            near[rnd.randrange(len(near))] = f"x{rnd.randrange(10_000)}"
        texts.append(" ".join(near))
    root, sizes = brute_components(texts, width)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs_of(spark, texts), neardup.Settings(width=width)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == root
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert all(got[i].kept == (root[i] == i) for i in range(len(texts)))


def test_bit_tables_never_hide_similar_sets(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(60):
        n = int(rng.integers(5, 700))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[: int(n * rng.uniform(0.6, 1))], rng.integers(0, 2**63, int(n * rng.uniform(0, 0.4))).astype(np.uint64)))
        a, b = np.unique(a), np.unique(b)
        rows.append((neardup.bit_table(a).tolist(), neardup.bit_table(b).tolist(), len(a), len(b), neardup.similar(a, b, 80)))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, n_a bigint, n_b bigint, similar boolean")
    got = df.select("similar", neardup.room(F.col("a"), F.col("b"), F.col("n_a"), F.col("n_b"), 80).alias("room")).collect()
    assert any(r.similar for r in got) and any(not r.room for r in got) and all(r.room for r in got if r.similar)


def test_dropping_near_duplicates_decides_by_row(spark):
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(7, text), (7, other), (3, text + " more"), (None, text), (None, "one of its kind in all of this table"), (9, None), (9, None), (2, "u " * 30), (2, "u " * 30)]
    got = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    left = [(7, other), (3, text + " more"), (None, "one of its kind in all of this table"), (9, None), (9, None), (2, "u " * 30)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, left))


def test_near_duplicates_of_odd_rows(odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1  # of the equal rows of id 1 one stays
    assert neardup.drop_near_duplicates(odd.limit(0)).count() == 0
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def brute_tiles(a, b, least):
    in_a, in_b, out = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not in_a[i + n] and not in_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        in_a[i : i + n] = [True] * n
        in_b[j : j + n] = [True] * n
        out += n


def test_tiling_covers_what_brute_force_covers():
    rnd = random.Random(6)
    for _ in range(60):
        a = [rnd.randrange(12) for _ in range(rnd.randrange(3, 30))]
        parts = [a[i : i + 6] for i in range(0, len(a), 6)]
        rnd.shuffle(parts)
        b = [99, *sum(([*p, rnd.randrange(12)] for p in parts), [])]
        found = decontam.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in found)
        assert len({p for i, _, n in found for p in range(i, i + n)}) == sum(n for *_, n in found)
        assert abs(sum(n for *_, n in found) - brute_tiles(a, b, 3)) <= 3


def test_decontamination(spark, odd):
    item = "the quick brown fox jumps over the lazy dog while nine grey cats sleep near an old stone wall"
    other = "tiny"
    words = item.split()
    moved = "well " + " ".join(words[9:]).upper() + "! and then " + " ".join(words[:9]) + " end"
    texts = ["a b c d e f g h", f"x y {item} z", moved, "the quick brown fox jumps over a fence", None, "", "so tiny."]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "  "), (4, other)], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontam.decontaminate(docs_of(spark, texts), bench).collect()}
    assert [got[i].contaminated for i in range(7)] == [False, True, True, False, False, False, True]
    assert got[1].coverage == 1.0 and got[2].tiles == 2 and got[2].coverage == 1.0 and got[6].item_id == 4
    assert decontam.decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.keep_clean(odd, bench).columns == odd.columns
    blocks = list(decontam.blocks(bench, "item_id", "text", 5, block_bytes=50))
    assert sorted(i for b in blocks for i in b.ids) == [1, 4]


def test_decontamination_in_blocks(spark):
    """Items in several blocks give what one block gives, ties included."""
    rng = random.Random(8)
    items = [" ".join(f"w{rng.randrange(400)}" for _ in range(12)) for _ in range(6)]
    bench = spark.createDataFrame([*enumerate(items), (6, items[0])], "item_id bigint, text string")
    texts = [f"some words {a} between {b} end" for a in items for b in items] + ["nothing of it", None]
    one, many = (
        sorted(decontam.with_coverage(docs_of(spark, texts), bench, block_bytes=n).select("doc_id", "_leak").collect())
        for n in (10**6, 60)
    )
    assert one == many
    assert len(list(decontam.blocks(bench, "item_id", "text", 5, 60))) > 2


def test_mixing_meets_targets(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(600):
        domain = ("good", "low", "toxic")[min(2, i % 4)] if i % 4 < 3 else "good"
        extra = {"good": [], "low": ["###", "%%%"], "toxic": ["idiot"]}[domain]
        rows.append((i, " ".join(rnd.choices(words, k=30) + extra * 2)))
        if i % 2 == 0 or domain != "good":
            labels.append((i, domain))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labelled = spark.createDataFrame(labels, "doc_id bigint, domain string")
    got = mixing.mix_rates(docs, labelled).collect()
    totals = {d: sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in got) for d in mixing.DOMAINS}
    for d in mixing.DOMAINS:
        assert totals[d] == pytest.approx(mixing.TARGETS[d] * sum(totals.values()), rel=1e-5)
    assert all(r.rate >= 0 and int(r.rate) <= r.copies <= r.rate + 1 for r in got)
    assert all(r.copies >= 1 for r in got if r.doc_id % 4 in (0, 3))


def least_squares(t, p, targets, steps=100_000):
    """Accelerated projected gradient on the same problem, one vector of rates; the distance reached and the metric."""
    metric = np.linalg.pinv((p * t[:, None]).T @ p, rcond=1e-9)
    r = y = np.ones(len(t))
    inertia = 1.0
    for _ in range(steps):
        new = np.maximum(y - p @ (metric @ ((t * y) @ p - targets)), 0)
        after = (1 + (1 + 4 * inertia**2) ** 0.5) / 2
        y, r, inertia = new + (inertia - 1) / after * (new - r), new, after
    miss = (t * r) @ p - targets
    return miss @ metric @ miss, metric


@pytest.mark.parametrize("reachable", [True, False])
def test_mixing_rates_against_plain_projected_gradient(spark, reachable):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.6, 0.4, 0.3], 300) if reachable else rng.dirichlet([2, 2, 2], 300) / 2 + 1 / 6
    t = rng.integers(0, 500, 300)
    t[:5] = 0
    targets = np.array([0.9, 0.05, 0.05]) * t.sum()
    rows = [(int(n), [float(x) for x in v]) for n, v in zip(t, p)]
    members = spark.createDataFrame(rows, "_tokens bigint, _p array<double>").coalesce(2).cache()
    found = mixing.fit(members, targets)
    rates = np.array([r.rate for r in members.select(mixing.rate(F.col("_p"), found.pull).alias("rate")).collect()])
    assert (rates >= 0).all()
    miss = (t * np.maximum(1 - p @ found.pull, 0)) @ p - targets
    assert np.allclose(miss / targets.sum(), found.residual, atol=1e-9)
    if reachable:
        assert np.abs(found.residual).sum() <= mixing.MET
    else:
        least, metric = least_squares(t.astype(float), p, targets)
        assert np.abs(found.residual).sum() > 0.01
        assert miss @ metric @ miss == pytest.approx(least, rel=1e-3)


def test_mixing_rates_without_tokens_or_with_a_domain_of_none(spark):
    kind = "_tokens bigint, _p array<double>"
    nothing = spark.createDataFrame([(0, [0.5, 0.5])], kind)
    assert mixing.fit(nothing, np.array([1.0, 1.0])).pull.tolist() == [0.0, 0.0]
    assert mixing.fit(nothing.limit(0), np.array([1.0, 1.0])).pull.tolist() == [0.0, 0.0]
    same = mixing.fit(spark.createDataFrame([(10, [0.8, 0.2, 0.0])] * 4, kind).coalesce(1).cache(), np.array([5.0, 5.0, 1.0]))
    rates = np.maximum(1 - np.array([0.8, 0.2, 0.0]) @ same.pull, 0)
    # along (0.8, 0.2) the nearest point to the targets
    assert 40 * rates == pytest.approx((5 * 0.8 + 5 * 0.2) / (0.8**2 + 0.2**2), rel=1e-3)


def test_mixing_of_the_table_meets_targets(spark):
    got = queries.op9_mixing(spark, SF_DIR).toPandas()
    sums = np.array([(got["n_tokens"] * got[f"p_{d}"] * got["rate"]).sum() for d in mixing.DOMAINS])
    assert np.allclose(sums / sums.sum(), [mixing.TARGETS[d] for d in mixing.DOMAINS], rtol=1e-3)


def test_mixing_tells_rare_words_and_the_commonest_domain_apart(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(800):
        domain = "toxic" if i % 13 == 0 else "good" if i % 3 else "low"
        # a toxic word is in fewer than 10 labelled documents; a low document only lacks the words of good ones
        own = {"toxic": [f"slur{(i // 13 + k) % 12}" for k in (0, 1)], "good": [f"praise{i % 5}"], "low": []}[domain]
        rows.append((i, " ".join(rnd.choices(words, k=30) + own), domain))
        if i % 4:
            labels.append((i, domain))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, domain string")
    got = mixing.mix_rates(docs, spark.createDataFrame(labels, "doc_id bigint, domain string")).collect()
    domain = {i: d for i, _, d in rows}
    for d in mixing.DOMAINS:
        unseen = [r for r in got if r.doc_id % 4 == 0 and domain[r.doc_id] == d]
        assert sum(r[f"p_{d}"] for r in unseen) >= 0.7 * len(unseen) > 0, d


def test_mixing_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, domain string")
    assert {r.rate for r in mixing.mix_rates(odd, none).collect()} == {1.0}
    some = spark.createDataFrame([(1, "good"), (6, "toxic"), (None, "low"), (2, "other")], "doc_id bigint, domain string")
    assert mixing.mix_rates(odd, some).count() == len(ODD)
    assert mixing.mix(odd, some).columns == odd.columns
    assert mixing.mix_rates(odd.limit(0), some).count() == 0


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_against_sql(spark, name):
    rows, problem = compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), sql.ORACLES[name])
    assert problem is None and rows > 0


def test_pipeline_keeps_what_each_stage_decides(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR)
        assert after.columns == docs.columns, name
        kept = corpus_pipeline.materialize(after, "test")
    texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: r[0])
    got = corpus_pipeline.run(spark, SF_DIR).orderBy("start").collect()
    assert [r.doc_id for r in got] == [i for i, _ in texts] and got[0].start == 0
    bench = [decontam.words_of(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    flat = [b" ".join(decontam.words_of(t)) for _, t in texts]
    assert not any(b" ".join(b) in t for b in bench for t in flat)
