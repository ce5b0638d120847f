"""Every corpus operator on a small awkward table, against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("id", "row", "t", "fp", "length", "count", "component")]
)
LONG = " ".join(f"word{k % 977} of{k % 31}" for k in range(30_000))
TEXTS = [
    "the quick brown fox jumps over the lazy dog and runs far away from here",
    "the quick  brown\tfox jumps over the\nlazy dog and runs far away from here",
    "The quick brown fox jumps over the lazy dog and runs far away from here",
    "", None, "   ", "\n\t ", "one", "one two", "one two three four", "é漢字🙂 <|endoftext|> don't", "a b   c", LONG, LONG + " tail",
    "line one here\nline one here\nline two", "# * $ % & | < >", "NO!! WAY!! OUT!!", "x" * 5000, "for " * 300,
]


def rows():
    out = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(TEXTS)]
    out += [(3, "", "en", "s", 0), (100, TEXTS[0], None, None, None), (100, TEXTS[0], None, None, None), (None, TEXTS[0], "en", "s", 1), (None, "only here", "en", "s", 1)]
    return [(*r, "x", "y", "z", "p", "q", "r", "u") for r in out]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def plain_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_exact_dedup(docs, none):
    import re

    from fringelake.llm.exact_dedup import drop_copies, exact_dedup

    groups = defaultdict(list)
    for r in rows():
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", r[1] or "")].append(r[0])
    for digest in (False, True):
        got = exact_dedup(docs, digest=digest).collect()
        assert len(got) == len(rows()) and sum(r["kept"] for r in got) == len(groups)
        want = Counter((i, min((x for x in ids if x is not None), default=None), len(ids)) for ids in groups.values() for i in ids)
        assert Counter((r["id"], r["keep_id"], r["group_size"]) for r in got) == want
        assert exact_dedup(none, digest=digest).count() == 0
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(min((x for x in ids if x is not None), default=None) for ids in groups.values())


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_exact_dedup_with_a_crowded_map(docs, monkeypatch, bits):
    """A map so small that every key shares its bit loses no row and joins no texts."""
    from fringelake.llm import exact_dedup as E

    monkeypatch.setattr(E, "MAP_BITS", bits)
    got = Counter((r["id"], r["keep_id"], r["group_size"]) for r in E.exact_dedup(docs).collect())
    assert got == Counter((r["id"], r["keep_id"], r["group_size"]) for r in E.exact_dedup(docs, digest=True).collect())


@pytest.mark.parametrize("module, name", [("exact_dedup", "drop_copies"), ("simhash", "drop_near_duplicates")])
def test_rows_keep_their_numbers_when_files_are_split_otherwise(spark, tmp_path, monkeypatch, module, name):
    """Executors that come or go change how files are split between two reads of one table."""
    import importlib

    from fringelake.llm import common

    made = importlib.import_module(f"fringelake.llm.{module}")
    texts = [(k, f"some words {k % 700} that are {k % 700 * 7} and more of {k % 700 * 13} them") for k in range(2000)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(6).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    assert common._from_files(docs) and not common._from_files(docs.join(docs.select("doc_id"), "doc_id"))
    splits = iter(["1m", "4k", "64k", "1k"])
    checkpointed, before = common.checkpointed, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def other_splits(frame):
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(splits, "2k"))
        return checkpointed(frame)

    monkeypatch.setattr(made, "checkpointed", other_splits)
    try:
        kept = sorted(r["doc_id"] for r in getattr(made, name)(docs).collect())
        texts_of_kept = {texts[k][1] for k in kept}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    if module == "exact_dedup":
        assert kept == list(range(700))
    else:
        assert len(texts_of_kept) == len(kept) and max(kept) < 700
        same = sorted(r["doc_id"] for r in getattr(made, name)(docs).collect())
        assert kept == same


def test_quality_ledger(docs, none):
    from fringelake.llm import quality_rules as Q

    def brute(text):
        ws, lines = plain_words(text), [x for x in (text or "").split("\n") if x.encode().split()]
        seen = Counter(zip(ws, ws[1:], ws[2:]))
        covered = {k + j for k in range(len(ws) - 2) if seen[tuple(ws[k : k + 3])] > 1 for j in range(3)}
        return len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)

    found = Q.ledger(docs).cache()
    got = Counter(tuple(r) for r in found.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == Counter((r[0], *brute(r[1])) for r in rows())
    for r in found.collect():
        assert bool(r["failed"] & Q.BIT["few_words"]) == (r["n_words"] < 50)
    told = {(r["policy"], r["version"], r["rule"]): r for r in Q.ablation(found).collect()}
    base = told["base", 1, "few_words"]
    assert base["n_failed"] == sum(len(plain_words(r[1])) < 50 for r in rows())
    assert base["n_kept"] == found.filter(Q.verdict(Q.POLICIES[0])).count()
    assert Q.ledger(none).count() == 0 and Q.ablation(Q.ledger(none)).count() == 0


def test_simhash(docs, none):
    from fringelake.llm import simhash as S
    from xxhash import xxh64_intdigest

    def brute(text):
        ws = words(text)
        grams = [b" ".join(ws[k : k + 4]) for k in range(max(1, len(ws) - 3))] if ws else []
        hs = [xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))

    fps = [(r[0], brute(r[1])) for r in rows()]
    parent = {fp: fp for _, fp in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in list(parent):
        for b in list(parent):
            if bin(a ^ b).count("1") <= 4:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, fp in fps:
        least[root(fp)].append(i)
    want = Counter((i, fp, min((x for x in least[root(fp)] if x is not None), default=None)) for i, fp in fps)
    got = S.near_duplicates(docs).collect()
    assert Counter((r["id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(least)
    assert S.near_duplicates(none).count() == 0
    assert S.drop_near_duplicates(docs).columns == docs.columns


def test_simhash_grid_loses_no_link(spark):
    from fringelake.llm import simhash as S
    from fringelake.llm.components import components

    draw = np.random.default_rng(1)
    seeds = draw.integers(0, 2**64, 60, np.uint64)
    fps = [int(s) for s in seeds]
    for s in seeds:
        for n in draw.integers(1, 7, 12):
            fps.append(int(s) ^ sum(1 << int(b) for b in draw.choice(64, n, replace=False)))
    fps = sorted(set(fps))
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    found = components(S.links(spark.createDataFrame(signed, "fp long").repartition(4)))
    got = {r["node"]: r["component"] for r in found.collect()}
    parent = {x: x for (x,) in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(fps):
        for b in fps[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                p, q = root(a - 2**64 if a >= 2**63 else a), root(b - 2**64 if b >= 2**63 else b)
                parent[max(p, q)] = min(p, q)
    for (x,) in signed:
        assert got.get(x, x) == root(x)


def test_components_of_a_path(spark):
    from fringelake.llm.components import components

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(7, 7), (100, 90), (90, 100)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 90, 90: 90}
    assert components(edges.filter("a < 0")).count() == 0


def test_packing(docs, none, spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from fringelake.llm import packing as K

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = K.pack_documents(docs).collect()
    want = Counter()
    for r in rows():
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, begin in enumerate(range(0, len(ids), 2048)):
            some = ids[begin : begin + 2048]
            want[r[0], piece, begin, len(some), zlib.crc32(some.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    placed = defaultdict(list)
    for r in got:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in placed.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert K.pack_documents(none).count() == 0


def test_word_tokenizer_is_the_tokenizer(monkeypatch):
    """Folding, lines with separators and a memory that forgets change no id."""
    import pyarrow as pa
    import public_tokenizers as P

    from fringelake.llm import packing as K

    monkeypatch.setattr(K, "KNOWN", 40)
    monkeypatch.setattr(K, "WORDS", 7)
    words = K.WordTokenizer(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())
    draw = np.random.default_rng(5)
    bits = ["Ab", "cd", "É", "ß", "İ", "H\u0331", "'s", "'", ".", ",;", "1", "23", "漢", "🙂", " ", "  ", "\n", "\t", "\x1c", "\xa0", "×", "<|endoftext|>", "<|startoftext|>", "<|endof"]
    texts = ["".join(draw.choice(bits, int(n))) for n in draw.integers(0, 12, 3000)]
    for some in (texts[:1500], texts[1000:]):
        got = words.encode_all(pa.array(some))
        want = words.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x.ids for x in want]


def test_byte_bpe_of_awkward_white_space(monkeypatch):
    import public_tokenizers as P
    import pyarrow as pa
    import tiktoken

    from fringelake.llm import bpe as B

    monkeypatch.setattr(B, "KNOWN", 30)
    ranks = B.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    truth = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = B.TextEncoder(B.Merges(ranks), P.PATTERN)
    draw = np.random.default_rng(6)
    bits = ["a", "bc", " ", "  ", "\n", "\xa0", "\u2009", "\u3000", "'s", "1", ".", "é", "漢", "🙂", "\x85", "\x1c", "\r\n", "\u200b", "\u180e", "\ufeff", "\x00"]
    texts = ["".join(draw.choice(bits, int(n))) for n in draw.integers(0, 12, 4000)]
    got = [bytes(x) for x in encoder.encode_all(pa.array(texts))]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [truth.encode_ordinary(t) for t in texts]
    assert [bytes(x).decode() for x in encoder.decode_all(got)] == texts


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_is_tight(seed):
    from fringelake.llm import packing as K

    draw = np.random.default_rng(seed)
    counts = np.bincount(np.clip(draw.lognormal(6, 1, 20_000).astype(int) + 1, 1, 2048), minlength=2049)
    plan = K.Plan(counts)
    assert plan.left.sum() == 0 and len(plan.slots) < 40_000
    assert plan.sequences <= 1.005 * np.ceil((counts * np.arange(2049)).sum() / 2048) + 2


def test_byte_bpe(docs, none):
    import public_tokenizers as P
    import tiktoken

    from fringelake.llm import bpe as B

    ranks = B.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    truth = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in rows():
        ids = np.array(truth.encode_ordinary(r[1] or ""), "<u4").tobytes()
        want[r[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    path = P.path("byte_bpe_50k.tiktoken")
    assert Counter(map(tuple, B.encode_digests(docs, path, P.PATTERN).collect())) == want
    assert B.encode_digests(none, path, P.PATTERN).count() == 0
    merges = B.Merges(ranks)
    table = B.PrefixEncoder(merges, b" hello wor")
    table.append(b"lds apart")
    assert table.ids() == B.PrefixEncoder(merges, b" hello worlds apart").ids()
    table.replace(3, 6, b"XX")
    assert table.ids() == B.PrefixEncoder(merges, b" heXX worlds apart").ids()


def test_chat(spark):
    from fringelake.llm import chat as C

    said = [(1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>b <\\| <\\\\|"), (2, 0, "assistant", None), (3, None, None, "x"), (3, 1, "us\ner%0A", "y\n"),
            (None, 0, "user", "z"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (5, 0, "user", C.TRICKY), (5, 1, "assistant", C.TRICKY)]
    frame = spark.createDataFrame([(*r, "extra") for r in said], "conv_id long, turn int, role string, text string, place string").repartition(5)
    segments = C.format_conversations(frame)
    by = defaultdict(list)
    for r in said:
        by[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    got = {r["conv_id"]: r for r in C.read_back(segments).collect()}
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[1]["valid"] and got[5]["valid"] and not got[2]["valid"] and not got[4]["valid"]
    assert C.read_back(C.format_conversations(frame.limit(0))).count() == 0
    parts = [(r["text"], r["loss"]) for r in segments.filter("conv_id = 1").orderBy("place").collect()]
    cut = parts
    assert [(role, text) for role, text, _ in C.parse(cut)] == [("user", "hi"), ("assistant", said[1][3])]


def test_ablation_by_plain_loops(docs):
    from fringelake.llm import quality_rules as Q

    found = Q.ledger(docs).cache()
    masks = [r["failed"] for r in found.select("failed").collect()]
    told = {(r["policy"], r["version"], r["rule"]): r for r in Q.ablation(found).collect()}
    assert len(told) == sum(bin(p.mask).count("1") for p in Q.POLICIES)
    for p in Q.POLICIES:
        for rule, bit in Q.BIT.items():
            if p.mask & bit:
                r = told[p.name, p.version, rule]
                assert r["n_failed"] == sum(bool(m & bit) for m in masks)
                assert r["n_kept"] == sum(not m & p.mask for m in masks)
                without = sum(not m & (p.mask & ~bit) for m in masks)  # the policy without the rule
                assert r["n_kept"] + r["n_kept_without"] == without


def test_chat_of_a_long_conversation_and_clashing_names(spark):
    """Ten thousand turns of one conversation, dealt over many partitions; columns that are named like the operator's own."""
    from fringelake.llm import chat as C

    turns = [(9, k, "user" if k % 2 == 0 else "assistant", f"turn {k} " + C.TRICKY * (k % 3)) for k in range(10_000)]
    turns += [(8, 0, "user", "é漢🙂" * 20_000), (8, 1, "assistant", "<|" * 30_000)]
    names = "place long, loss boolean, error string, state string, segments string, n_turns long"
    frame = spark.createDataFrame([(*t, 5, True, "x", "y", "z", 1) for t in turns], f"conv_id long, turn int, role string, text string, {names}").repartition(13)
    got = {r["conv_id"]: r for r in C.read_back(C.format_conversations(frame)).collect()}
    for conv in (8, 9):
        own = [(role, text) for c, _, role, text in turns if c == conv]
        loss = "".join(text for role, text in own if role == "assistant")
        r = got[conv]
        assert r["valid"] and r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_html_with_clashing_names(spark):
    from fringelake.llm import html_extract as H

    page = "<article><p>One two three.</p></article>"
    names = "text string, n_chars long, tokens string, score double, weights string"
    frame = spark.createDataFrame([(1, "u", page, "old", 99, "t", 0.5, "w"), (2, None, None, None, None, None, None, None)], f"page_id long, url string, html string, {names}")
    assert sorted(map(tuple, H.extract_pages(frame).collect())) == [(1, "u", "One two three.", 14), (2, None, "", 0)]


def test_html(spark):
    from fringelake.llm import html_extract as H

    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t='</p>';</script></head><body><header>Site</header>"
        "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad'>Buy this now please</div>"
        "<article><h1>Head &amp; line</h1><p><b>One two three four five<br><p>six\n seven&nbsp;<i>eig</i>ht</p><aside>no</aside><form>mail <input></form>"
        "<p>Of.</p><div class=\"comments\"><p>I disagree with this a lot</p></div></article><div id=sidebar>more</div><footer>&copy; me</footer></body></html>"
    )
    want = "Head & line One two three four five six seven eight Of."
    weights = H.learn([page] * 3)
    assert H.extract(page, weights) == want and H.extract(page) == want
    assert H.extract("", weights) == "" and H.extract("<p></p>", weights) == "" and H.extract("just words", weights) == "just words"
    frame = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", ""), (1, "u", page)], "page_id long, url string, html string")
    got = sorted(map(tuple, H.extract_pages(frame).collect()), key=str)
    assert got == sorted([(1, "u", want, len(want)), (2, None, "", 0), (None, "v", "", 0), (1, "u", want, len(want))], key=str)
    assert H.extract_pages(frame.limit(0)).count() == 0
    scores = np.random.default_rng(0).normal(-0.2, 1, 60).tolist()
    first, last = H.best_region(scores)
    assert abs(sum(scores[first:last]) - max(sum(scores[a:b]) for a in range(60) for b in range(a + 1, 61))) < 1e-9


NAMES = "header notice search-and-rescue share-price form-of-words widget-review related-work".split()


@pytest.mark.parametrize("name", NAMES)
def test_names_are_no_veto_inside_an_article(name):
    from fringelake.llm import html_extract as H

    page = "<nav><a href=x>Menu</a></nav><div class=ad>Buy it now</div><article><h1>Title</h1>%s<p>End.</p></article><footer>f</footer>"
    section = f'<section class="{name}"><p>Some more words here.</p><div class="{name} note"><p>Inner.</p></div></section>'
    for weights in (H.DEFAULT, H.learn([page % ""] * 50)):
        assert H.extract(page % section, weights) == "Title Some more words here. Inner. End."
        for out in ("comments", "ad", "cookie-notice", "sidebar", "ad-banner"):
            assert H.extract(page % f'<div class="{out}"><p>Not of the article at all.</p></div>', weights) == "Title End."


def test_names_are_learned_from_pages():
    from fringelake.llm import html_extract as H

    page = "<div class='teaser ad'>Buy it now for less</div><article><p>Words of it.</p><section class='comments'><p>These are part of the text.</p></section></article>"
    weights = H.learn([page] * 400)
    assert weights["name"]["teaser"] < -4 and weights["name"]["comments"] > -1
    assert H.extract(page, weights) == "Words of it. These are part of the text."
    assert H.extract("<article><p>One.</p><div class=teaser>out</div><p>Two.</p></article>", weights) == "One. Two."


@pytest.mark.parametrize("seed", range(6))
def test_unmarked_pages_give_the_best_region(seed):
    """Brute force: of all runs of tokens the one with the largest sum, its words, and nothing else."""
    from fringelake.llm import html_extract as H

    draw = np.random.default_rng(seed)
    tags = ["p", "div", "li", "a", "h2", "span", "section", "aside", "div class=ad", "div class=notice", "br"]
    weights = H.learn(["<nav><ul><li><a>m</a></li></ul></nav><div class=x>side words</div><article><h2>t</h2><p>some words <span>of</span> it</p></article>"])
    for weights in (H.DEFAULT, weights):
        for _ in range(25):
            word = iter(f"w{k}" for k in range(1000))
            parts = []
            for _ in range(int(draw.integers(1, 14))):
                tag = str(draw.choice(tags))
                text = " ".join(next(word) for _ in range(int(draw.integers(0, 9))))
                parts.append(f"<{tag}> {text} " + (f"</{tag.split()[0]}>" if draw.random() < 0.7 else ""))
            page = H.Page("".join(parts))
            scores = H.scored(page, weights)
            # Of equal sums the run that ends first, and of those the shortest.
            best, b, a = max((round(sum(scores[a:b]), 9), -b, a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))
            want = [w for (t, _), s in zip(page.tokens[a:-b], scores[a:-b]) if t and s > 0 for w in t.split()] if best > 0 else []
            assert H.extract("".join(parts), weights).split() == want


def test_links_and_boxes_around_unmarked_text_stay_out():
    from fringelake.llm import html_extract as H

    links = "<div class=links><ul>" + "".join(f"<li><a href=x>Link{k}</a></li>" for k in range(12)) + "</ul></div>"
    text = "<h1>Head line</h1><p>First paragraph with <a href=y>a link</a> of it.</p><p>The second paragraph follows here.</p><p>End.</p>"
    page = f"<header>Site</header>{links}<div class=content>{text}</div><div id=sidebar><p>side text</p></div>{links}<div class=comments><p>I say no to all that</p></div>"
    want = "Head line First paragraph with a link of it. The second paragraph follows here. End."
    marked = f"<nav><ul><li><a>m</a></li></ul></nav><div class=ad>side</div><article>{text}</article>"
    assert H.extract(page) == want and H.extract(page, H.learn([marked] * 20)) == want


@pytest.mark.parametrize("part", ["<div>", "<b>", "<p><b>", "<li>a", "<table><tr><td>", '<a href="x>', "<", "<!--", "<script>", "</p>", "<p class='", "<div></p>"])
def test_pages_are_read_in_linear_time(part):
    import time

    from fringelake.llm import html_extract as H

    began = time.process_time()
    H.extract(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 3


def test_lm_counts_and_shape(docs, none):
    from fringelake.llm import lm

    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(r[0], [w.decode() for w in words(r[1])] + [lm.END]) for r in rows()]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tokens)
    got = lm.score_documents(docs).collect()
    assert Counter((*r[:5], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert lm.score_documents(none).count() == 0


def test_lm_is_normalised_and_carries_state():
    from fringelake.llm import lm

    texts = ["aa bb cc aa bb cc", "xx yy zz xx yy zz"] * 60
    network, speller = lm.fit(texts, ["aa", "bb", "cc", "xx", "yy", "zz"])
    states = np.random.default_rng(0).uniform(-1, 1, (5, lm.HIDDEN)).astype(np.float32)
    assert np.allclose(np.exp(network.class_log(states)).sum(axis=1), 1, atol=1e-4)
    ids = np.arange(1, 7)
    p = sum(np.exp(network.member_log(states[:1], np.array([i]))) * (network.class_of[i] == network.class_of[1]) for i in ids)
    assert np.isclose(p[0], 1, atol=1e-4)
    code = lambda t: np.array([network.frequent[w] for w in t.split()] + [0])
    many = [code(t) for t in ("aa bb cc aa bb cc", "aa", "cc bb aa aa cc", "aa yy cc zz bb")]
    together = network.score(many, [np.zeros(len(t)) for t in many])
    alone = [network.score([t], [np.zeros(len(t))])[0] for t in many]
    assert np.allclose(together, alone, atol=1e-3)
    assert together[0] / len(many[0]) > together[3] / len(many[3])


def small_network(classes=3, seed=4):
    from fringelake.llm import lm

    frequent = [f"w{k}" for k in range(30)]
    speller = lm.Speller({"^w1": np.array([1.0, 0, 0, 0, 0, 0])}, np.log(np.full(lm.GROUPS, 1 / lm.GROUPS)))
    network = lm.Network.blank(frequent, speller)
    draw = np.random.default_rng(seed)
    network.weights = {k: draw.normal(0, 0.4, v.shape) for k, v in network.weights.items()}  # of double precision
    return network, speller


def plain_log_likelihood(network, ids):
    """One word after the other, one gate after the other; no state of another text, no batches."""
    from fringelake.llm import lm

    w, size = network.weights, lm.HIDDEN
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, before, total = np.zeros(size), 0, 0.0
    for word in ids:
        a, u = w["in"][before], h @ w["u"]
        z, r = sigmoid(a[:size] + u[:size]), sigmoid(a[size : 2 * size] + u[size : 2 * size])
        n = np.tanh(a[2 * size :] + r * u[2 * size :])
        h = (1 - z) * n + z * h
        x = h @ w["c"] + w["cb"]
        own = network.class_of[word]
        total += x[own] - np.log(np.exp(x).sum())
        if network.member_of[word] >= 0:
            many = int(network.members[own])
            y = h @ w["m"][own - 1, :many].T + w["mb"][own - 1, :many]
            total += y[network.member_of[word]] - np.log(np.exp(y).sum())
        before = word
    return total


def test_lm_scores_by_plain_loops():
    network, _ = small_network()
    draw = np.random.default_rng(8)
    texts = [np.r_[draw.integers(1, len(network.class_of), n), 0] for n in (0, 1, 5, 40, 7)]
    rare = [draw.normal(size=len(t)) for t in texts]
    got = network.score(texts, rare)
    assert np.allclose(got, [plain_log_likelihood(network, t) + r.sum() for t, r in zip(texts, rare)], atol=1e-4)


def test_lm_backpropagation_has_the_slopes_of_the_loss():
    """Numerical slopes of the mean negative log-likelihood of one window, the state given."""
    network, _ = small_network()
    draw = np.random.default_rng(9)
    x, y = draw.integers(0, len(network.class_of), (3, 6)), draw.integers(0, len(network.class_of), (3, 6))
    x[:, 0], x[1, 3] = 0, 0
    h0 = np.zeros((3, network.weights["u"].shape[0]))

    def loss():
        h, total = h0, 0.0
        for t in range(x.shape[1]):
            h = network.step(h * (x[:, t] != 0)[:, None], x[:, t])[0]
            total -= network.class_log(h)[np.arange(3), network.class_of[y[:, t]]].sum()
            some = np.flatnonzero(network.member_of[y[:, t]] >= 0)
            total -= float(network.member_log(h[some], y[some, t]).astype(float).sum())
        return total / y.size

    slopes = network._window(h0, x, y)[1]
    for name, weight in network.weights.items():
        used = np.argwhere(np.abs(slopes[name]) > 1e-3)
        assert len(used)
        for at in map(tuple, used[:: max(1, len(used) // 6)]):
            held, sides = weight[at], []
            for step in (1e-3, -1e-3):
                weight[at] = held + step
                sides.append(loss())
            weight[at] = held
            assert np.isclose((sides[0] - sides[1]) / 2e-3, slopes[name][at], rtol=2e-2, atol=2e-4), (name, at)


def test_spelling_of_many_words_is_that_of_each():
    import pyarrow as pa

    from fringelake.llm import lm

    words_ = ["", "a", "ab.", ".,;", "über,", "strasse!", "x1", "漢字", "abcdefgh;", "é"]
    draw = np.random.default_rng(1)
    table = {p: draw.normal(size=lm.GROUPS) for w in words_[1:7] for p in lm.spelling(w)}
    speller = lm.Speller(table, np.log(np.full(lm.GROUPS, 1 / lm.GROUPS)))
    want = []
    for w in words_:
        odds = speller.prior + sum(table.get(p, np.zeros(lm.GROUPS)) for p in lm.spelling(w))
        want.append(3 * int(odds.argmax()) + (0 if w[-1:].isalpha() else 1 if w and w[-1] in ".,;" else 2))
    assert speller.kinds(pa.array(words_)).tolist() == want


def test_lm_trains_on_every_training_text_and_on_no_other(spark):
    """Weights move with texts beyond the sample; held-out texts move nothing."""
    from fringelake.llm import lm

    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 != 2]
    out = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 == 2]
    draw = np.random.default_rng(0)
    one = lambda k, word: (k, " ".join([word] * 6 + [f"r{n}" for n in draw.integers(0, 50, 30)]))
    texts = [one(k, "common") for k in ids[:400]] + [one(k, "hidden") for k in out[:60]]
    score = lambda rows_: {r["doc_id"]: r["score"] / r["n_tokens"] for r in lm.score_documents(spark.createDataFrame(rows_, "doc_id long, text string").repartition(4)).collect()}
    got = score(texts)
    assert np.mean([got[k] for k in ids[:400]]) > np.mean([got[k] for k in out[:60]]) + 0.1


def test_lm_learns_spelling_from_every_training_text(spark):
    """2,400 texts, more than the 1,500 that the classes by spelling were learned from once: as if counted in one place."""
    import pyarrow as pa

    from fringelake.llm import lm

    draw = np.random.default_rng(2)
    one = lambda k: " ".join([f"{'ab'[k % 2]}{n}" for n in draw.integers(0, 5, 6)] + [f"{'xy'[k % 2]}{'qrstuvw'[n]}{n}z" for n in draw.integers(0, 7, 6)])
    texts, telling = [one(k) for k in range(2400)], [f"{c}{n}" for c in "ab" for n in range(5)]
    frame = spark.createDataFrame([(k, k % 7 == 2, t) for k, t in enumerate(texts)], "id long, held boolean, t string").repartition(4)
    written = lm.checkpointed(frame.mapInArrow(lm._blocked, lm._BLOCKS))
    got = lm.learned(written.select("ids", "sizes", "words", "codes"), telling)
    want = Counter(p for k, t in enumerate(texts) if k % 7 != 2 for w in t.split() for p in lm.spelling(w))
    assert set(got.table) == {p for p, n in want.items() if n > 2}
    alone = lm.fit([t for k, t in enumerate(texts) if k % 7 != 2], telling)[1]
    assert np.allclose(np.sort(got.prior), np.sort(alone.prior))
    groups = {c: set(got.groups(pa.array([w for t in texts for w in t.split() if w[0] == c])).tolist()) for c in "xy"}
    assert not groups["x"] & groups["y"]


def test_lm_trains_every_block_in_one_round_of_growing_ones():
    from fringelake.llm import lm

    sizes = np.random.default_rng(0).integers(1, 8 << 20, 3000).tolist()
    dealt = lm.rounds(sizes)
    bytes_ = [sum(n for n, k in zip(sizes, dealt) if k == r) for r in range(max(dealt) + 1)]
    assert len(dealt) == 3000 and dealt == sorted(dealt) and set(dealt) == set(range(max(dealt) + 1))
    assert bytes_[0] >= lm.FIRST and all(n >= lm.MORE * sum(bytes_[:r]) for r, n in enumerate(bytes_[:-1]) if r)
    assert lm.rounds([5]) == [0] and lm.rounds([]) == []


def held_out(spark, sf_dir, query, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = [r for r in query(spark, sf_dir).collect()]
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    return [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]


def test_classifiers_on_held_out_rows(spark):
    from fringelake.llm.quality_model import op7_quality_classifier
    from fringelake.llm.toxicity import op1_toxicity

    quality = held_out(spark, "/root/testdata/sf0.01", op7_quality_classifier, "quality")
    assert np.mean([p == y for p, y in quality]) > 0.95
    toxic = held_out(spark, "/root/testdata/sf0.1", op1_toxicity, "toxic")
    assert np.mean([p == y for p, y in toxic]) > 0.93  # 0.887 are not toxic; a tenth of the labels of the larger tables


def test_classifiers_without_labels(spark, docs, none):
    from fringelake.llm import labelled, quality_model, toxicity

    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for frame in (docs, none):
        ids, texts, y = labelled.sample(frame, labels, "toxic", 4, 2)
        assert len(ids) == len(texts) == len(y) <= 1
    assert toxicity.fit([], np.zeros(0)).scorer()(["a", ""]).tolist() == [0, 0]
    assert quality_model.fit([], np.zeros(0)).score(["a", ""]).tolist() == [1, 1]


def test_sample_is_of_whole_texts_within_its_bounds(spark):
    from fringelake.llm import common, labelled

    docs = spark.createDataFrame([(k, "x" * (10 + k), k) for k in range(40)] + [(5, "y" * 30, 0), (50, "z" * 5000, 0)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(7, 1)], "doc_id long, toxic int")
    ids, texts, y = labelled.sample(docs, labels, "toxic", 4, 2, chars=100, rows=12)
    length = {k: 10 + k for k in range(40)} | {5: 30}
    assert all(len(t) in (length[i], 15) for i, t in zip(ids, texts)) and 50 not in ids
    for kind in (0, 1):
        assert 0 < sum(len(t) for t, own in zip(texts, y) if own == kind) <= 100
    whole = labelled.sample(docs, labels, "toxic", 4, 2)
    assert whole[0] == sorted(i for i in [*range(40), 50] if zlib.crc32(str(i).encode()) % 4 != 2)
    assert common.within([3, 9, 4, 4, 1], 8) == [0, 2, 4]


def write_tables(spark, path, texts, labels):
    """documents with columns of clashing names, and labels of a small corpus; texts as of (id, text)."""
    rows_ = [(i, t, "en", "s", None, *(["x"] * 7)) for i, t in texts]
    spark.createDataFrame(rows_, SCHEMA).repartition(3).write.mode("overwrite").parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(path / "labels.parquet"))
    return str(path)


def labelled_corpus():
    """Rude and plain texts, poor and good ones, and the awkward ones of TEXTS."""
    draw = np.random.default_rng(3)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(draw.choice(syllables, int(draw.integers(1, 4))))
    texts, labels = [], []
    for k in range(240):
        said = [word() for _ in range(int(draw.integers(20, 60)))]
        if k % 3 == 0:
            said = [w for x in said for w in (x, str(draw.choice(["halfwit", "numbskull"])))]
        if k % 4 == 0:
            said = [x + str(draw.choice(["###", "%%%", "&&&"])) for x in said]
        texts.append((1000 + k, " ".join(said)))
        labels.append((1000 + k, int(k % 4 != 0), int(k % 3 == 0)))
    texts += [(r[0], r[1]) for r in rows()]
    return texts, labels + [(None, 1, 1), (0, None, None), (1, 1, 0), (1, 1, 0)]


def test_toxicity_query_by_plain_loops(spark, tmp_path):
    """Each window is compressed by itself with compressors made anew, each feature is counted by itself."""
    import zstandard

    from fringelake.llm import toxicity as X

    texts, labels = labelled_corpus()
    path = write_tables(spark, tmp_path, texts, labels)
    model = X.fitted(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    level = zstandard.ZstdCompressionParameters.from_level(X.LEVEL)

    def length(data, content):
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=level)
        return len(zstandard.ZstdCompressor(compression_params=level, dict_data=raw).compress(data))

    def brute(text):
        said = (text or "").encode().lower().split()
        excess = []
        for k in range(0, len(said), X.WINDOW):
            data = model.ordinary[: X.LEAD] + b" " + b" ".join(said[k : k + X.WINDOW]) + b" "
            excess.append(length(data, model.ordinary + bytes(len(model.toxic))) - length(data, model.ordinary + model.toxic))
        excess = excess or [0]
        top = sorted(excess, reverse=True)
        x = [top[0], sum(top[:2]) / len(top[:2]), sum(top[:4]) / len(top[:4]), sum(excess) / len(excess), np.log(len(excess))]
        over = [sum(e > t for e in excess) for t in model.thresholds]
        x += [np.log(1 + n) for n in over] + [n / len(excess) for n in over]
        z = sum(w * (v - m) / d for w, v, m, d in zip(model.weights, x, model.mean, model.deviation)) + model.weights[-1]
        return 1 / (1 + np.exp(-min(30, max(-30, z))))

    got = X.op1_toxicity(spark, path).collect()
    short = [(i, t) for i, t in texts if len(t or "") < 10_000]
    want = defaultdict(list)
    for i, t in short:
        want[i].append(round(brute(t), 6))
    seen = defaultdict(list)
    for r in got:
        seen[r["doc_id"]].append(round(r["score"], 6))
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    assert len(got) == len(texts) and all(sorted(seen[i]) == sorted(v) for i, v in want.items())
    truth = {i: t for i, _, t in labels if i and i >= 1000}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]) > 0.95
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    assert X.op1_toxicity(spark, path).count() == 0


def test_quality_query_by_plain_loops(spark, tmp_path):
    """Each word's vector is looked up by itself, each mean and each layer is summed by itself."""
    from fringelake.llm import quality_model as Q

    texts, labels = labelled_corpus()
    path = write_tables(spark, tmp_path, texts, labels)
    model = Q.fitted(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    v = model.vectors

    def vector(word):
        if word in v.words:
            return v.matrix[v.words[word]].astype(float), 0
        parts = [v.matrix[v.parts[p]] if p in v.parts else np.zeros(Q.SIZE) for p in Q.affixes(word)]
        return (parts[0].astype(float) + parts[1]) / 2, 1

    def brute(text):
        said = (text or "").split()
        x = np.zeros(2 * Q.SIZE + 3)
        if said:
            vectors = [vector(w) for w in said]
            n = len(said)
            mean = sum(a for a, _ in vectors) / n
            spread = np.sqrt(np.maximum(sum(a * a for a, _ in vectors) / n - mean**2, 0))
            alike = sum(float(a @ b) for (a, _), (b, _) in zip(vectors, vectors[1:])) / n
            same = sum(a == b for a, b in zip(said, said[1:])) / n
            x = np.r_[mean, spread, alike, same, sum(u for _, u in vectors) / n]
        z = (x - model.mean) / model.deviation
        w1, b1, w2, b2 = model.layers
        hidden = [np.tanh(sum(z[i] * w1[i, j] for i in range(len(z))) + b1[j]) for j in range(Q.HIDDEN)]
        out = sum(h * w for h, w in zip(hidden, w2)) + b2
        return 1 / (1 + np.exp(-min(30, max(-30, out / model.temperature))))

    got = Q.op7_quality_classifier(spark, path).collect()
    want, seen = defaultdict(list), defaultdict(list)
    for i, t in texts:
        want[i].append(brute(t))
    for r in got:
        seen[r["doc_id"]].append(r["score"])
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    assert len(got) == len(texts)
    for i, scores in want.items():
        assert np.allclose(sorted(seen[i]), sorted(scores), atol=2e-3), i
    truth = {i: q for i, q, _ in labels if i and i >= 1000}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]) > 0.95
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    assert Q.op7_quality_classifier(spark, path).count() == 0


def test_quality_network_has_the_slopes_of_its_loss():
    from fringelake.llm import quality_model as Q

    draw = np.random.default_rng(2)
    x = draw.normal(size=(80, 5))
    y = (x[:, 0] + 0.3 * draw.normal(size=80) > 0).astype(float)
    share = draw.uniform(0.1, 1, 80) / 80
    layers = [draw.normal(size=(5, Q.HIDDEN)), draw.normal(size=Q.HIDDEN), draw.normal(size=Q.HIDDEN), np.array(0.2)]

    def loss():
        out = Q._forward(x, layers)[1]
        return (share * np.logaddexp(0, np.where(y == 1, -out, out))).sum() + Q.DECAY / 2 * ((layers[0] ** 2).sum() + (layers[2] ** 2).sum())

    for layer, slope in zip(layers, Q.slopes(x, y, share, layers)):
        for at in ((0,) * layer.ndim, tuple(n - 1 for n in layer.shape)):
            held, sides = float(layer[at]), []
            for step in (1e-5, -1e-5):
                layer[at] = held + step
                sides.append(loss())
            layer[at] = held
            assert np.isclose((sides[0] - sides[1]) / 2e-5, np.asarray(slope)[at], atol=1e-7)
    assert np.mean((Q._forward(x, Q.network(x, y))[1] > 0) == y) > 0.95


def test_pipeline_on_an_awkward_table(spark, tmp_path):
    """Nulls, empties, a long text, repeated rows, clashing names; then an empty table."""
    import corpus_pipeline as P

    texts, labels = labelled_corpus()
    path = write_tables(spark, tmp_path, texts, labels)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, docs, path)
        assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    packed = P.run(spark, path).collect()
    truth = {i: t for i, _, t in labels if i and i >= 1000}
    assert packed and {r["doc_id"] for r in packed} <= {i for i, _ in texts}
    assert np.mean([truth[i] for i in {r["doc_id"] for r in packed} if i in truth]) < 0.05
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    assert P.run(spark, path).count() == 0


def test_scores_of_awkward_texts():
    from fringelake.llm import quality_model, toxicity

    draw = np.random.default_rng(0)
    plain = lambda n: [f"w{k}{c}" for k, c in zip(draw.integers(0, 200, n), draw.choice(list("aeiou"), n))]
    good, bad = ["a fine day in the park with friends"] * 20, ["&&& %%% $$$ ### @@@ !!!"] * 20
    sets = [(quality_model.fit, [f"{t} {k}" for k, t in enumerate(good + bad)])]
    # Near copies count once, so insults must stand among different words to be learned.
    rude = [" ".join(w for x in plain(20) for w in (x, draw.choice(["halfwit", "numbskull"]))) for _ in range(20)]
    sets.append((toxicity.fit, rude + [" ".join(plain(40)) for _ in range(20)]))
    y = np.r_[np.ones(20), np.zeros(20)]
    for fit, texts in sets:
        model = fit(texts, y)
        s = (model.scorer() if fit is toxicity.fit else model.score)(["", LONG, *texts])
        assert ((s >= 0) & (s <= 1)).all() and np.mean((s[2:] >= 0.5) == y) > 0.9


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as P

    names = [name for name, _ in P.STAGES]
    assert names == ["toxicity", "quality classifier", "exact dedup", "SimHash near-dedup", "best-fit packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = P.run(spark, sf_dir)
    kept = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    texts = [" ".join((r["text"] or "").split()) for r in docs.filter(docs.doc_id.isin(list(kept))).collect()]
    assert len(texts) == len(set(texts))


def test_filter_stages_act_on_the_verdicts_of_the_queries(spark, tmp_path):
    """Too few labels make the score the share of ones among them: 0.4 is toxic, 0.25 is poor."""
    import corpus_pipeline as P
    from fringelake.llm.common import crc_mod
    from fringelake.llm.queries import QUERIES

    texts = [(k, f"text number {k}") for k in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [r["doc_id"] for r in docs.filter((crc_mod("doc_id", 4) != 2) & (crc_mod("doc_id", 5) != 0)).orderBy("doc_id").collect()]
    toxic = [(k, None, int(n < 2)) for n, k in enumerate(seen[:5])]
    good = [(k, int(n < 1), None) for n, k in enumerate(seen[5:9])]
    spark.createDataFrame(toxic + good, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage, stays in (("op1_toxicity", P.drop_toxic, 0), ("op7_quality_classifier", P.drop_poor, 1)):
        told = QUERIES[name](spark, str(tmp_path)).collect()
        assert {round(r["score"], 9) for r in told} == {0.4 if stays == 0 else 0.25}
        want = {r["doc_id"] for r in told if r["predicted"] == stays}
        assert {r["doc_id"] for r in stage(spark, docs, str(tmp_path)).collect()} == want


def test_run_keeps_what_the_verdicts_leave(spark, sf_dir, tmp_path):
    """Brute force: the queries' verdicts one after the other, then the least id of equal texts; no other document is packed."""
    import corpus_pipeline as P
    from fringelake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stays) in enumerate((("op1_toxicity", 0), ("op7_quality_classifier", 1))):
        folder = tmp_path / str(number)
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(folder / "labels.parquet"))
        verdict = QUERIES[name](spark, str(folder)).filter(f"predicted = {stays}").select("doc_id").distinct()
        docs = spark.read.parquet(str(folder / "documents.parquet")).join(verdict, "doc_id", "left_semi")
    least = {}
    for r in docs.orderBy("doc_id").collect():
        least.setdefault(" ".join((r["text"] or "").split()), r["doc_id"])
    left = P.drop_near_copies(spark, docs.filter(docs.doc_id.isin(list(least.values()))), sf_dir)
    packed = {r["doc_id"] for r in P.run(spark, sf_dir).select("doc_id").distinct().collect()}
    assert packed == {r["doc_id"] for r in left.collect() if (r["text"] or "").split()}


def test_html_sample_does_not_shrink_with_the_share_of_articles(spark, monkeypatch):
    from fringelake.llm import html_extract as H

    seen = []
    learn = H.learn
    monkeypatch.setattr(H, "learn", lambda pages: seen.append(len(pages)) or learn(pages))
    pages = [(k, "u", "<article><p>Some words of it here.</p></article>" if k % 40 == 0 else "<p>none</p>") for k in range(4000)]
    H.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert seen == [100]
