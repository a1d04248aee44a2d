"""Operators against brute force, the libraries, round trips and held-out accuracy."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from nightaudit.llm import (bpe, chat, decontamination, html_pages, html_text, langid, near_dup, quality, registry,
                            secrets, token_counts, token_output)
from nightaudit.llm.common import table
from tools.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, duck_small, name):
    assert compare(name, registry.QUERIES[name](spark, SF), registry.ORACLE_SQL[name], duck_small)


# ---- edge cases, every operator on documents

def _run(name, d):
    bench = d.sparkSession.createDataFrame([(7, "repeated row with several plain words in it"), (8, None), (9, "")],
                                           "item_id long, text string")
    return {"secrets": lambda: secrets.scan(d), "near_dup": lambda: near_dup.near_duplicates(d),
            "quality": lambda: quality.score(d, ["doc_id"]), "bpe": lambda: bpe.digests(d),
            "decontamination": lambda: decontamination.hits(d, bench),
            "langid": lambda: langid.identify(d, langid.train(d))}[name]()


@pytest.mark.parametrize("name", ["secrets", "near_dup", "quality", "bpe", "decontamination", "langid"])
def test_edge_rows_and_empty_table(docs, edge_rows, name):
    assert _run(name, docs(edge_rows)).count() == len(edge_rows)
    assert _run(name, docs([])).count() == 0


def test_filters_keep_columns_and_clean_rows(docs, edge_rows):
    d = docs(edge_rows)
    bench = d.sparkSession.createDataFrame([(7, "repeated row with several plain words in it")], "item_id long, text string")
    assert quality.filter_documents(d).columns == d.columns
    assert near_dup.keep_one(d).columns == d.columns and near_dup.keep_one(d).count() == 6
    left = decontamination.remove_documents(d, bench)
    assert left.columns == d.columns and left.count() == 5
    assert secrets.redact(d).columns == d.columns and secrets.redact(d).count() == 7


# ---- 1: token output

def test_range_coder_round_trip_and_damage():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 49408, rng.integers(0, token_output.BLOCK + 1)).astype(np.uint32) for _ in range(12)]
    blocks += [np.zeros(2000, np.uint32), np.tile(np.arange(7, dtype=np.uint32) * 7000, 200), np.full(3, 49407, np.uint32)]
    model = token_output.Model(49408)
    coded = token_output.code_blocks(blocks, model)
    for a, b in zip(blocks, token_output.decode_blocks(coded, [len(b) for b in blocks], model)):
        assert np.array_equal(a, b)
    assert len(coded[-3]) < 200  # 2000 equal ids
    body = token_output.pack_segments([np.concatenate(blocks)], model)[0]
    assert np.array_equal(token_output.unpack_segments([body])[0], np.concatenate(blocks))
    with pytest.raises(ValueError, match="damaged"):
        token_output.unpack_segments([body[:-9] + bytes([body[-9] ^ 1]) + body[-8:]])


def test_token_output_equals_library(spark, docs, edge_rows, tmp_path):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    rows = sorted(edge_rows[1:4] + edge_rows[5:] + [(9, "Élan vital <|endoftext|> İ ﬁ Σ \n x", None, None)])
    token_output.write_tokens(docs(rows), str(tmp_path / "t"))
    got = sorted(token_output.read_tokens(spark, str(tmp_path / "t"), True).collect())
    start = 0
    for (doc_id, text, _, _), r in zip(rows, got):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc_id, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    token_output.write_tokens(docs([]), str(tmp_path / "none"))
    assert token_output.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_word_ids_equal_library_on_hostile_texts(monkeypatch):
    """Marks, special tokens, long words, other scripts, joining signs and control characters; also with a cache that
    overflows in every batch."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path(token_output.TOKENIZER)
    lib, rng = Tokenizer.from_file(path), random.Random(5)
    parts = ["|", "||", "a|b", "<|endoftext|>", "<|startoftext|>x", "It's", "DON'T", "'s", "x.,;", "é", "e\u0301", "\u0301", "İ",
             "ΣΑΣ", "ß", "µ", "\xa0", "\x85", "\xad", "\x1c", "\t", "\r\n", "\n\n", "日本語", "한글", "ﬁ", "k" * 60, "½²", "१२",
             "\U0001f511", "\u200d", "#@*", "Wörter", "ÀÉ", "Ǆ", "…", "\u2028"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "  "]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    texts += [None, "", " ", "\n", "x" * 200_000]
    for most in (token_output.CACHED_WORDS, 10):
        monkeypatch.setattr(token_output, "CACHED_WORDS", most)
        tok = token_output.WordTokenizer(path)
        for at in range(0, len(texts), 500):
            part = texts[at:at + 500]
            ids, edges = tok.encode_batch(pa.array(part, pa.string()).slice(0))
            for t, a, b in zip(part, edges[:-1], edges[1:]):
                assert ids[a:b].tolist() == lib.encode(t or "", add_special_tokens=False).ids, repr(t)
        assert all(len(w) <= token_output.LONGEST_CACHED for w in tok.known)
    assert [len(x) for x in tok.encode_batch(pa.array([], pa.string()))] == [0, 1]


@pytest.mark.parametrize("vocabulary", [300, 49408, 1 << 20])
def test_coder_takes_any_vocabulary(vocabulary):
    """Blocks of rare, repeated and boundary ids, for small and large vocabularies; order 0 and the blend save space."""
    rng = np.random.default_rng(vocabulary)
    edges = np.array([0, 1, 255, 256, 257, vocabulary - 2, vocabulary - 1], np.uint32)
    few = rng.integers(0, vocabulary, 40).astype(np.uint32)
    blocks = [rng.choice(edges, 700), rng.choice(few, 2048), rng.integers(0, vocabulary, 2048).astype(np.uint32), np.zeros(0, np.uint32),
              np.tile(few, 50)]
    model = token_output.Model(vocabulary)
    coded = token_output.code_blocks(blocks, model)
    for a, b in zip(blocks, token_output.decode_blocks(coded, [len(b) for b in blocks], model)):
        assert np.array_equal(a, b)
    raw = 2048 * (vocabulary - 1).bit_length() / 8
    assert len(coded[1]) < 0.75 * raw or vocabulary < 512  # repeated ids in no order: a slot of order 0
    assert len(coded[4]) < 600  # one cycle, over and over: orders 1 and 2 agree


def test_words_that_differ_in_case_or_last_signs_are_encoded_once():
    """Also where folding would be wrong: marks, special tokens, contractions, signs behind digits, letters beyond Latin-1."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path(token_output.TOKENIZER)
    lib, tok = Tokenizer.from_file(path), token_output.WordTokenizer(path)
    tok.encode_batch(pa.array(["Élan élan, ÉLAN. élan!? dog Dog; DOG..."]))
    assert set(tok.known) == {"", "élan", "dog", ",", ".", "!?", ";", "..."}
    letters = [chr(c) for c in range(0xc0, 0x180)] + ["J\u030c", "H\u0331", "a\u0301", "Ω", "ǅ", "×", "÷", "µ", "ª"]
    texts = [f"{a}{b}{c}" for a in ["", "x", "don't", "'S", "2", "<|ENDOFTEXT|>", "<|endoftext|>"] for b in ["", *letters]
             for c in ["", ",", "...", "'.", "|.", "\t.", ".a", "\xa0!"]]
    ids, edges = tok.encode_batch(pa.array(texts))
    for t, a, b in zip(texts, edges[:-1], edges[1:]):
        assert ids[a:b].tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("vocabulary", [5, 49408, 1 << 24])
def test_sorted_contexts_are_those_of_the_decoder(monkeypatch, vocabulary):
    """The coder needs no tables of contexts, the decoder does; blocks of all lengths, with id 0 in empty slots, carries
    and more lanes than are sorted together."""
    rng = np.random.default_rng(vocabulary)
    blocks = [rng.integers(0, min(vocabulary, rng.choice([2, 300, vocabulary])), n).astype(np.uint32)
              for n in [0, 1, 2, 3, 2047, 2048, *rng.integers(0, 90, 150)]]
    blocks += [np.tile(rng.integers(0, vocabulary, 9).astype(np.uint32), 20), np.zeros(64, np.uint32)]
    model = token_output.Model(vocabulary)
    with monkeypatch.context() as m:
        m.setattr(token_output, "_Lanes", None)
        coded = token_output.code_blocks(blocks, model)
    assert all(len(c) % 4 == 0 for c in coded)
    for a, b in zip(blocks, token_output.decode_blocks(coded, [len(b) for b in blocks], model)):
        assert np.array_equal(a, b)
    assert token_output.code_blocks([blocks[4]], model) == [coded[4]]  # a block does not depend on its neighbours


def test_bits_are_packed_in_runs():
    rng = np.random.default_rng(1)
    counts = np.array([0, 5, 0, 1, 700, 0, 33])
    widths = rng.integers(0, 33, counts.sum())
    values = rng.integers(0, 1 << 32, counts.sum()) & ((1 << widths) - 1)
    words, lengths = token_output.pack_bits(values, widths, counts)
    assert len(words) == lengths.sum()
    assert np.array_equal(token_output.unpack_bits(words, np.cumsum(lengths) - lengths, widths, counts), values)
    assert [len(x) for x in token_output.pack_bits(values[:0], widths[:0], counts * 0)] == [0, len(counts)]


# ---- 2: secrets

def test_secret_spans(docs):
    blob = "aB3dE5gH7jK9mN1pQ3sT5vX7zZ2"
    texts = ["é password: 'hunter2hunter2' end", "token=short1 token=longenough", "AKIA" + "A" * 11, "x " + "AKIA" + "B" * 12,
             "id " + "0f" * 16, f"see {blob} here", "550e8400-e29b-41d4-a716-446655440000", "thanbleshaningtionntword",
             "secret=token =\"abcdefgh1\""]
    got = {r.doc_id: [(s["name"], s["start"], s["end"]) for s in r.spans]
           for r in secrets.scan(docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert got[0] == [("assign", 2, 27)]
    assert got[1] == [("assign", 13, 29)]
    assert got[2] == [] and got[3] == [("access", 2, 18)]
    assert got[4] == [("hex", 3, 35)]
    assert [k for k, _, _ in got[5]] == ["entropy"] and got[5][0][1] >= 4
    assert got[6] == [] and got[7] == [] and got[8] == []
    red = {r.doc_id: r.text for r in secrets.redact(docs([(0, texts[0], None, None), (5, "clean", None, None)])).collect()}
    assert red == {0: "é [SECRET]' end", 5: "clean"}


def test_entropy_by_window(docs):
    rng = random.Random(4)

    def drawn(letters, n):
        return "".join(rng.sample(letters, len(letters)) * n)[:n]
    upper_hex, low, alnum = drawn("0123456789ABCDEF", 40), drawn("ghijklmn0123456789abcdef", 24), drawn("ABCDEFGHJKMN23456789"[:16], 24)
    word = "plainlowercasewordsthatgoonandon"
    texts = [f"sha1={upper_hex}", f"id_{low}", alnum, f"{word}/{upper_hex}", f"example={upper_hex}", word, f"x={word}",
             "550e8400-e29b-41d4-a716-446655440000", "some/plain_path/with-words", "0123456789abcdefghijklmnop"]
    got = {r.doc_id: [(s["name"], s["start"], s["end"]) for s in r.spans]
           for r in secrets.scan(docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, key in ((0, upper_hex), (1, low), (2, alnum), (3, upper_hex), (4, upper_hex)):
        at = texts[i].index(key)
        assert any(k == "entropy" and a <= at and b == at + len(key) for k, a, b in got[i]), (i, got[i])
    assert all(got[i] == [] for i in range(5, len(texts)))


def test_entropy_beside_base_spans_stays(docs):
    access, blob = "AKIA" + "QRSTUVWXYZ234567", "wJalrXUtnFEMIqK7MDENGzbPxRfiCYkd93hTq2Lm"
    text = f"id {access}/{blob} {access}/{blob}/{access}-{blob}= end"
    d = docs([(0, text, None, None)])
    spans = [(s["name"], s["start"], s["end"]) for s in secrets.scan(d).first().spans]
    assert all(b <= c for (_, _, b), (_, c, _) in zip(spans, spans[1:])) and [k for k, _, _ in spans] == ["access", "entropy"] * 3
    red = secrets.redact(d).first().text
    assert access not in red and not any(blob[i:i + 8] in red for i in range(len(blob) - 7))


def _secret_texts(n):
    """Texts with glued keys, allow-listed strings and base kinds, many of which meet or overlap."""
    rng = random.Random(11)
    letters = ["0123456789abcdef", "0123456789ABCDEF", "0123456789abcdefghijklmnopqrstuvwxyz",
               "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"]
    fixed = ["password=", "api_key: '", "token=", "AKIA", "example", "placeholder", "0123456789", "xxxxxx", "aaaaaaaaaaaaaaaaaaaaaaa",
             "550e8400-e29b-41d4-a716-446655440000", "some/plain_path/with-words", "lower", "UPPER", "\n", "é ", "\U0001f511", ", ", "==="]

    def piece():
        if rng.random() < 0.5:
            return rng.choice(fixed)
        return "".join(rng.choices(rng.choice(letters), k=rng.choice([3, 12, 16, 19, 20, 21, 32, 45])))
    return ["".join(piece() + rng.choice(["", "", "=", "/", "-", "_", " ", " "]) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_secrets_equal_sql_on_drawn_texts(spark, tmp_path):
    """The registered query against its SQL, on a table that holds entropy spans of every window class."""
    rows = [(i, t) for i, t in enumerate([*_secret_texts(300), None, ""])] + [(5, "sha1=" + "0123456789ABCDEF" * 3)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = secrets.op2_secret_scans(spark, str(tmp_path))
    spans = ",".join(r.spans for r in got.collect())
    assert spans.count("entropy") > 100 and spans.count("assign") > 20 and spans.count("hex") > 5
    assert compare("op2_secret_scans", got, secrets.ORACLE_SQL["op2_secret_scans"], con)


# ---- 3: token counts

def test_rollup_is_idempotent(spark, tmp_path):
    def rows(*r):
        return spark.createDataFrame(list(r), token_counts.CHANGE)
    t = token_counts.TokenRollup(spark, str(tmp_path))
    assert t.totals().count() == 0
    assert t.apply(1, rows(("insert", 1, "a", "en", "v1", 10, 0), ("insert", 2, "a", None, "v1", 5, 0),
                           ("insert", None, "a", "en", "v1", 9, 0), ("insert", 3, None, "en", "v1", 7, 0)))
    second = rows(("revise", 1, "b", "en", "v1", 12, 0), ("delete", 2, None, None, "v1", None, 0),
                  ("delete", 99, "a", "en", "v1", 1, 0), ("revise", 4, "a", "en", "v2", 3, 0),
                  ("revise", 4, "a", "en", "v2", 4, 1))
    assert t.apply(2, second)
    want = {("b", "en", "v1", 1, 12), (None, "en", "v1", 1, 7), ("a", "en", "v2", 1, 4)}
    assert set(map(tuple, t.totals().collect())) == want
    assert not t.apply(2, second) and not t.apply(1, second)
    t.compact()
    assert set(map(tuple, t.totals().collect())) == want
    assert t.apply(3, rows(("delete", 3, None, None, "v1", None, 0)))
    assert set(map(tuple, t.totals().collect())) == want - {(None, "en", "v1", 1, 7)}
    assert t.apply(4, rows()) and t.totals().count() == 2


# ---- 4: near-duplicates

def test_near_duplicates_equal_brute_force(spark, docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 220))]
        for _ in range(rng.choice([1, 2, 8])):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((n, " ".join(words).upper() if n % 5 == 0 else " ".join(words), None, None))
            n += 1
    rows += [(n, "", None, None), (n + 1, None, None, None), (n + 2, "a b", None, None), (n + 3, "A  b", None, None)]

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {i: shingles(t) for i, t, _, _ in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_circulant_signature_estimates_jaccard():
    rng = np.random.default_rng(2)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (3000, 400, 600))
    sig = near_dup.signatures([np.concatenate([common, a]), np.concatenate([common, b])])
    assert abs((sig[0] == sig[1]).mean() - 0.75) < 0.09


# ---- 5: chat

def test_template_language():
    def render(template, **scope):
        return "".join(s for _, s in chat.compiled(template)(scope))
    assert render("{{ 'a' + 'b' | upper }}{% if 1 == 2 %}x{% elif not n %}y{% else %}z{% endif %}", n=0) == "aBy"
    assert render("{% for m in l %}{{ m['k'] }}{% if not loop.last %},{% endif %}{% endfor %}", l=[{"k": 1}, {"k": 2}]) == "1,2"
    folded = chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% endif %}{% if false %}e{% endif %}"))
    assert [n.expr.value for n in folded if isinstance(n, chat.Output)] in (["abcd"], ["abc", "d"])
    for bad in ("{{ x.y() }}", "{% import os %}", "{{ x | nothing }}", "{% if x %}", "{{ 'a' 'b' }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)
    with pytest.raises(chat.TemplateError):
        render("{{ x.__class__ }}", x="s")


def test_chat_escape_and_loss_mask(spark):
    for s in ("<|", "<\\|", "<\\\\| <|x|>", "a<", "\\|", "", chat.HOSTILE):
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
        assert chat.unfield(chat.field(s + "\n\\n")) == s + "\n\\n"
    rows = [(1, 1, "assistant", chat.HOSTILE), (1, 0, "user", "<|im_end|>\n"), (2, 0, None, None), (None, 3, "assistant", "x<"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert [chat.unescape(whole[1].text[s.start:s.end]) for s in whole[1].loss] == [chat.HOSTILE]
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n<|im_end|>\n\nassistant\n{chat.HOSTILE}\n".encode()).hexdigest()
    assert got[3].n_turns == 2 and got[3].loss_chars == 8 and got[None].loss_chars == 2
    assert got[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert all(got[k].formatted_chars == len(whole[k].text) for k in got)
    assert chat.digests(df.limit(0)).count() == 0


# ---- 6: html

def test_crf_on_held_out_layouts():
    crf = html_text.train()
    wrong = total = 0
    for page in html_pages.labelled_pages(150, seed=77):
        blocks = html_text.blocks_of(page)
        wrong += sum(b.main != bool(x) for b, x in zip(blocks, crf.decode(blocks)))
        total += len(blocks)
    assert wrong < 0.01 * total
    page = ("<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two<p>Three <b>four</b>.<br>five"
            "</p><div class=ad>Buy now.</div><script>x='</p>'</script></article><section id=comments><p>Nice post, thanks."
            "</p></section><footer>&copy; me</footer>")
    assert html_text.main_text(crf, page) == "A & B\nOne two\nThree four. five"
    assert html_text.main_text(crf, None) == "" and html_text.main_text(crf, "<p") in ("", "<p")


def test_open_head_ends_where_the_body_begins():
    crf = html_text.train()
    start, end = "<!DOCTYPE html><html><head><meta charset=utf-8><title>T</title><style>p{}</style>\n", "<p>Three four five, six.</p>"
    want = "A heading\nOne two three four."
    for page in (start + "<article><h1>A heading</h1><p>One two three four.", start + "</head><body><article><h1>A heading</h1><p>One "
                 "two three four.", start + "<noscript><div>No.</div></noscript><article><h1>A heading</h1><p>One two three four."):
        assert html_text.main_text(crf, page) == want
    assert [b.text for b in html_text.blocks_of(start + "Plain <b>text</b>" + end)] == ["Plain text", "Three four five, six."]
    assert [b.text for b in html_text.blocks_of(start + "<a href=/>Link</a>" + end)] == ["Link", "Three four five, six."]


# ---- 7: quality

def test_quality_counts_equal_brute_force(spark, docs, edge_rows):
    rows = edge_rows[1:4] + edge_rows[5:] + [(10, "a b c d e f g h " * 6 + "\nx\n\nx\nx", "en", "a"), (11, "### $ one %", "en", "a")]
    d = docs(rows).union(spark.createDataFrame([], docs([]).schema))
    for r in quality.score(d, ["doc_id"]).collect():
        text = next(t for i, t, _, _ in rows if i == r.doc_id) or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        seen = {w for w in windows if windows.count(w) > 1} if len(windows) < 5000 else {
            w for w, n in __import__("collections").Counter(windows).items() if n > 1}
        hit = {i + j for i, w in enumerate(windows) if w in seen for j in range(8)}
        assert (r.q_n_words, r.q_word_chars, r.q_n_dup_lines, r.q_n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(hit))
        assert r.q_n_symbols == len(re.findall(r"[#*$%&|<>]", text))


def test_outliers_go_and_clean_texts_stay(docs):
    rng = random.Random(1)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = [(i, prose(rng.choice([25, 80, 400, 2000])), "en", "s" if i % 3 else None) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "***" for w in prose(200).split()), "en", "s") for i in range(60)]
    kept = {r.doc_id: r.q_kept for r in quality.score(docs(rows + junk), ["doc_id"]).collect()}
    assert all(kept[i] for i, *_ in rows) and not any(kept[i] for i, *_ in junk)


def test_short_outliers_go(docs):
    rng = random.Random(2)

    def prose(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    rows = [(i, " ".join(prose(rng.choice([25, 40, 80, 400]))), "en", "s") for i in range(400)]
    # Symbols at a tenth to a seventh of the characters.
    junk = [(1000 + i, " ".join(w + "*" * (k % 2) for k, w in enumerate(prose(40))), "en", "s") for i in range(40)]
    got = {r.doc_id: r for r in quality.score(docs(rows + junk), ["doc_id"]).collect()}
    assert all(got[i].q_kept for i, *_ in rows) and not any(got[i].q_kept for i, *_ in junk)


# ---- 8: BPE

def test_bpe_equals_library(docs):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    parts = ["'", "s", "t", "re", "ve", "ll", "l", "r", "e", "v", "m", "d", "a", "B", "é", " ", "  ", "\n", "\t", "1", "²", "!",
             "-", "漢", " ", " ", "👍", "'S", "ᲊ", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 3000, "'" * 2001, "xyz" * 4000, "漢字" * 3000, ""]
    enc = bpe.Encoder(ranks)
    ids = enc.encode_batch(texts)
    assert ids == [lib.encode_ordinary(t) for t in texts]
    assert all(enc.decode(x) == t.encode() for x, t in zip(ids, texts))
    spans = bpe.token_spans(enc, ids[0])
    assert [texts[0].encode()[a:b] for a, b in spans] == [enc.decode([i]) for i in ids[0]]
    rows = [(i, t, None, None) for i, t in enumerate(texts[:20])] + [(99, None, None, None)]
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs(rows))).collect()}
    assert back == {i: t or "" for i, t, _, _ in rows}


def test_scan_equals_a_walk():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 5000):
        classes = rng.integers(0, bpe.N_CLASSES, n).astype(np.uint8)
        state, want = bpe.S_BEGIN, []
        for c in classes:
            state = bpe.TRANSITIONS[c, state]
            want.append(state)
        assert bpe.scan_states(classes).tolist() == want


# ---- 9: decontamination

def test_blocks_of_benchmark_windows_give_the_same(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    one, many = decontamination.hits(d, b), decontamination.hits(d, b, max_broadcast=300)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_short_items_spans_and_case(docs, spark):
    bench = spark.createDataFrame([("x", "Two WORDS"), ("y", "one two"), ("z", "!!!")], "item_id string, text string")
    rows = [(1, "One two words, one", None, None), (2, "two É words", None, None), (3, "ÉTWO two words", None, None)]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontamination.hits(docs(rows), bench).collect()}
    assert got == {1: (4, 3, ["x", "y"]), 2: (3, 0, []), 3: (3, 2, ["x"])}
    assert {r.doc_id: r.text for r in decontamination.remove_spans(docs(rows), bench).collect()} == {
        1: "one", 2: "two É words", 3: "ÉTWO"}


# ---- 10: language

def test_language_held_out_accuracy(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.identify(d, langid.train(d)).withColumnRenamed("doc_id", "i")
    right = got.filter("held_out").join(d, F.col("i") == F.col("doc_id")).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_all_languages_are_learned(docs):
    names = [f"l{i:03}" for i in range(70)]
    # Ids 1 to 9 of a language: the first two texts have no letter, and some ids are held out.
    rows = [(100 * i + k, "123 !" if k < 3 else f"text {k} of {name}", name, None) for i, name in enumerate(names)
            for k in range(1, 10)]
    d = docs(rows)
    assert langid.train(d).languages == names
    assert langid.train(d, sample_total=7).languages == names


def test_language_undetermined(docs, edge_rows):
    d = docs(edge_rows)
    net = langid.ByteCnn(["de", "en"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(d, net).collect()}
    assert got[1] == got[2] == got[5] == ("und", 0.0) and got[4][0] in ("de", "en") and 0 <= got[4][1] <= 1
    x = langid.windows_of("straße und wörter" * 40)[0]
    slow = net.gradients(x, np.zeros(len(x), int))  # the tables must give what the filters give
    assert slow["out"].shape == net.params["out"].shape
    p = net.params
    e = p["embed"][x]
    h = np.concatenate([np.maximum((np.concatenate([e[:, j:langid.WINDOW - w + 1 + j] for j in range(w)], axis=2) @ p[f"filter{w}"]
                                    + p[f"bias{w}"]).max(axis=1), 0) for w in langid.WIDTHS], axis=1)
    assert np.allclose(net.predict(x, net.tables()), net._softmax(h), atol=1e-4)


# ---- columns of the table that are called like the operators' own

CLASHES = ["pool", "symbols", "capitals", "repeats", "bin", "x", "m", "c", "b", "q_doc", "q_id", "q_key", "q_spans", "_bad_id",
           "q_gone", "text_key", "set_key", "kept", "spans", "row_key", "kind", "start", "word", "Key", "unit"]


@pytest.mark.parametrize("name", ["quality", "near_dup", "decontamination", "secrets"])
def test_filters_pass_clashing_columns(docs, edge_rows, name):
    d = docs(edge_rows).drop("words", "key", "label").withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    bench = d.sparkSession.createDataFrame([(7, "repeated row with several plain words in it")], "item_id long, text string")
    out = {"quality": lambda x: quality.filter_documents(x), "near_dup": near_dup.keep_one, "secrets": secrets.redact,
           "decontamination": lambda x: decontamination.remove_documents(x, bench)}[name]
    made = out(d)
    assert made.columns == d.columns
    rows = made.collect()
    assert rows or name == "quality"
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHES)
    assert out(d.limit(0)).count() == 0


def test_keep_one_keeps_every_different_text(docs):
    a, b = "one two three four five six seven eight nine ten", "north south east west up down left right in out"
    other = "red green blue yellow orange purple black white pink grey"
    rows = [(3, a, "en", "a"), (7, a, "en", "a"), (7, b, "en", "a"), (8, other, "en", "a"), (8, b + " on", "en", "a"),
            (3, a, "en", "a"), (3, a.replace(" ", "  "), "en", "a"), (9, None, "en", "a"), (9, None, "en", "a"), (None, a, "en", "a")]
    kept = sorted((str(r.doc_id), " ".join((r.text or "-").split())) for r in near_dup.keep_one(docs(rows)).collect())
    # The second texts of 7 and of 8 are nearly the same: one of them stays.
    assert [x for x in kept if not x[1].startswith("north")] == sorted([("3", a), ("8", other), ("9", "-"), ("9", "-"), ("None", a)])
    assert [x for x in kept if x[1].startswith("north")] in ([("7", b)], [("8", b + " on")])


# ---- 6: short, bare and deep pages

@pytest.fixture(scope="module")
def field():
    return html_text.train()


@pytest.mark.parametrize("html,text", [
    ("<article><p>One plain sentence stands here.</p></article>", "One plain sentence stands here."),
    ("<html><body>Bare text in the body of a page, with a sentence or two. It ends here.</body></html>",
     "Bare text in the body of a page, with a sentence or two. It ends here."),
    ("<body><div><h1>A heading</h1><p>First paragraph of text.</p><p>Second one follows it.</p></div><div>&copy; 2024 Firm</div></body>",
     "A heading\nFirst paragraph of text.\nSecond one follows it."),
    ("<article><p>Text with <math><mi>x</mi></math> &amp; more of it.</p></article>", "Text with x & more of it."),
    ("<article><p>A sentence, 3 &lt; 4 &eacute;.</p></article>", "A sentence, 3 < 4 é."), (None, ""), ("", "")])
def test_short_and_bare_pages(field, html, text):
    assert html_text.main_text(field, html) == text


@pytest.mark.parametrize("html", ["<div>x " * 20_000, "<span>" * 100_000 + "y",
                                  "".join(f"<div class=n{i}>x " for i in range(20_000)), "<div>" * 8_000 + "</p>" * 8_000])
def test_deep_pages_take_linear_time(field, html):
    began = time.process_time()
    html_text.main_text(field, html)
    assert time.process_time() - began < 10


def test_short_layouts_held_out(field):
    wrong = total = 0
    for page in html_pages.labelled_pages(0, seed=77, short=200):
        blocks = html_text.blocks_of(page, field.known)
        wrong += sum(b.main != bool(x) for b, x in zip(blocks, field.decode(blocks)))
        total += len(blocks)
    assert wrong < 0.03 * total
