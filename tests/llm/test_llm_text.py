"""Extraction, archives, token files, SentencePiece and quality rules against brute force."""
import html
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("public_tokenizers")

from faultline.llm import archive, density, pieces, quality, queries, tokenfile  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from faultline.llm.common import open_folder, shared_folder, tokenizer_file  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ------------------------------------------------------------------------------ main text
def article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_main_text_is_the_article(spark, pages):
    expected = {r.page_id: article(r.html) for r in pages.collect()}
    got = queries.op2_text_density(spark, SF).collect()
    assert len(got) == len(expected)
    for r in got:
        assert (r.text, r.n_chars) == (expected[r.page_id], len(expected[r.page_id]))


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("  ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
    ("<div class='comments'>no</div><div>yes\n  sir</div>", "yes sir"), ("<p title=\"a>b\">q</p>", "q"),
    ("<p title=\"a>q</p>", "q"), ("x < y", "x < y"), ("<script>var a='<p>no</p>'</script><p>yes</p>", "yes"),
    ("<ul><li>a<li>b</ul>", "a\nb"), ("</div></p>x", "x"), ("<nav>menu</nav>", ""), ("<p>a<br>b</p>", "a b"),
    ("<body><aside>side</aside><article><header><h1>T</h1></header><p>x</p></article></body>", "T\nx"),
])
def test_main_text_cases(page, text):
    assert density.main_text(page) == text


def _text(n, size):
    return (f"t{n}" + " abcd" * size)[:size].strip()


@pytest.mark.parametrize("sections, paragraphs, size", [(2, 3, 200), (4, 5, 300)])
@pytest.mark.parametrize("tag", ["section", "div"])
def test_main_text_has_all_sections(sections, paragraphs, size, tag):
    texts = [[_text(f"{i}.{j}", size) for j in range(paragraphs)] for i in range(sections)]
    body = "".join(f"<{tag}><h2>S{i}</h2>" + "".join(f"<p>{t}</p>" for t in ts) + f"</{tag}>" for i, ts in enumerate(texts))
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(20)) + "</ul>"
    expected = "\n".join(["T", *(x for i, ts in enumerate(texts) for x in (f"S{i}", *ts))])
    assert density.main_text(f"<body><div>{menu}</div><article><h1>T</h1>{body}</article><div>{menu}</div></body>") == expected
    # nested: all but the last section in a block of their own
    cut = body.rindex(f"<{tag}>")
    assert density.main_text(f"<body><div><h1>T</h1><div>{body[:cut]}</div>{body[cut:]}</div>{menu}</body>") == expected


def test_main_text_has_the_paragraphs_beside_a_long_list():
    texts, items = [_text(i, 300) for i in range(3)], [_text(f"i{i}", 150) for i in range(8)]
    page = "<article><h1>T</h1>" + "".join(f"<p>{t}</p>" for t in texts) + "<ul>" + "".join(f"<li>{t}</li>" for t in items) + "</ul></article>"
    assert density.main_text(f"<body><nav>menu</nav>{page}<footer>foot</footer></body>") == "\n".join(["T", *texts, *items])


@pytest.mark.parametrize("name", [
    "class='content has-sidebar'", "class=no-sidebar", "class='article-header'", "class='comments-open'",
    "class='social-share-enabled'", "id='ad-free'", "class='sidebar'", "id=banner"])
def test_main_text_inside_wrappers(name):
    texts = "<h1>T</h1><p>some text of the article</p><p>and some more of it</p>"
    side = "<div class='sidebar'>side</div><div id='comments-list'><p>a reader</p></div>"
    expected = "T\nsome text of the article\nand some more of it"
    assert density.main_text(f"<body><div {name}><article>{texts}</article></div>{side}</body>") == expected
    assert density.main_text(f"<body><div {name}><article>{texts}</article>{side}</div></body>") == expected
    assert density.main_text(f"<body><div {name}>{texts}</div>{side}</body>") == expected


@pytest.mark.parametrize("name", ["sidebar", "sidebar-left", "left-sidebar widget", "ad", "ad-slot-2", "ad-300x250", "cookie-banner",
                                  "nav-menu", "site-footer", "social-share", "post-comments", "related_items", "x newsletter-signup"])
def test_named_parts_are_left_out(name):
    page = f"<body><div><h1>T</h1><p>some text of an article</p></div><div class='{name}'><p>not of it</p></div></body>"
    assert density.main_text(page) == "T\nsome text of an article"
    # readers' comments may be articles themselves, and longer than the page's own
    page = f"<body><article><p>short</p></article><div class='{name}'><article>a long remark by a reader</article></div></body>"
    assert density.main_text(page) == "short"


STORY = [_text(i, 260) for i in range(3)]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in STORY)


@pytest.mark.parametrize("beside", [
    "<div><p>Copyright 2020 by the paper, all rights reserved, no copies of any kind are allowed anywhere</p></div>",
    "<section id='reviews'><p>" + _text(9, 300) + "</p><p>" + _text(8, 200) + "</p></section>",
    "<div class='user-comments'><p>" + _text(9, 300) + "</p></div>", "<div class='cookie-consent'><p>" + _text(9, 3000) + "</p></div>"])
def test_nothing_beside_an_article_is_taken(beside):
    page = f"<body>{beside}<div><article><h1>T</h1>{PARAGRAPHS}</article>{beside}</div>{beside}</body>"
    assert density.main_text(page) == "\n".join(["T", *STORY])


@pytest.mark.parametrize("name", ["top-stories", "legal", "reader-comments", "cookie-consent"])
def test_containers_of_another_kind_beside_a_story_stay_out(name):
    other = f"<div class='{name}'><p>{_text(9, 200)}</p></div>"
    page = f"<body>{other}<div class='story'><h1>T</h1>{PARAGRAPHS}</div>{other}</body>"
    assert density.main_text(page) == "\n".join(["T", *STORY])


def test_named_contents_are_never_the_article():
    page = f"<body><div><p>{STORY[0]}</p></div><div class='cookie-consent'><p>{_text(9, 3000)}</p></div></body>"
    assert density.main_text(page) == STORY[0]
    page = f"<body><article>{PARAGRAPHS}<div class='user-comments'><p>{_text(9, 500)}</p></div></article></body>"
    assert density.main_text(page) == "\n".join(STORY)


def test_links_inside_an_article_stay():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(6)) + "</ul>"
    names = [f"link {i}" for i in range(6)]
    assert density.main_text("<body><article><p><a href='/x'>all of it</a></p></article></body>") == "all of it"
    assert density.main_text(f"<body><article><p>{STORY[0]}</p>{links}<p>{STORY[1]}</p></article></body>") == "\n".join([STORY[0], *names, STORY[1]])
    # without an article element a list of links needs text on both sides
    page = f"<body><div>{links}<p>{STORY[0]}</p>{links}<p>{STORY[1]}</p>{links}</div></body>"
    assert density.main_text(page) == "\n".join([STORY[0], *names, STORY[1]])


def test_articles_inside_an_article_are_remarks():
    page = f"<body><article>{PARAGRAPHS}<div><article><p>a remark</p></article><article><p>another</p></article></div></article></body>"
    assert density.main_text(page) == "\n".join(STORY)


def test_hostile_pages_take_linear_time():
    import time
    pages = ["<div>" * 20_000 + "</b>" * 100_000, "<b>" * 20_000 + "x", "<" * 500_000 + ">", "<![CDATA[" * 60_000 + "x",
             "<header>" * 20_000, "<li><p>" * 10_000 + "<b>" * 10_000, "<a \"" * 100_000, "<p>" * 50_000, "<!" * 200_000 + ">"]
    for page in pages:
        began = time.process_time()
        density.main_text(page)
        assert time.process_time() - began < 4, page[:20]


def test_densities_are_those_of_the_formula():
    """Against counts taken anew from each element's own subtree."""
    import random
    rng = random.Random(7)

    def tree(depth):
        tag = rng.choice(["div", "section", "p", "a", "b", "span"])
        inner = "".join(tree(depth - 1) if depth and rng.random() < 0.6 else "w" * rng.randint(1, 30) + " " for _ in range(rng.randint(1, 4)))
        return f"<{tag}>{inner}</{tag}>"

    def texts(node):
        for c in node.children:
            if isinstance(c, str):
                yield c
            else:
                yield from texts(c)

    def below(node):
        for c in node.children:
            if not isinstance(c, str):
                yield c
                yield from below(c)

    def links(node):
        """Outermost links from here down, this element too."""
        if node.tag == "a":
            return [node]
        return [x for c in node.children if not isinstance(c, str) for x in links(c)]

    def counts(node):
        chars = sum(len(" ".join(t.split())) for t in texts(node))
        link_chars = sum(len(" ".join(t.split())) for x in links(node) for t in texts(x))
        link_tags = len(list(below(node))) if node.tag == "a" else sum(len(list(below(x))) + 1 for x in links(node))
        return chars, len(list(below(node))), link_chars, link_tags
    for _ in range(60):
        body, nodes = density.parse("".join(tree(4) for _ in range(3)))
        density._count(nodes)
        bc, _, blc, _ = counts(body)
        for node in nodes:
            c, t, lc, lt = counts(node)
            assert (node.chars, node.tags, node.link_chars, node.link_tags) == (c, t, lc, lt)
            want = 0.0
            if c:
                scale = math.log(math.log(c / max(c - lc, 1) * lc + blc / max(bc, 1) * c + math.e))
                want = c / max(t, 1) * (math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / scale if scale > 1e-9 else 1)
            assert density._density(node, body) == pytest.approx(want)


def test_main_text_survives_anything():
    for page in ("<" * 5000, "<div>" * 3000 + "x", "<a \"" * 5000 + ">", "<!--" * 100, "&" * 1000, "<p " + "a=b " * 5000 + ">x"):
        density.main_text(page)


def test_main_text_keeps_other_columns(spark):
    rows = spark.createDataFrame([(1, "<p>a</p>", "old", 2), (1, "<p>a</p>", "old", 2), (None, None, None, None)],
                                 "page_id long, html string, text string, kind int")
    got = density.extract(rows).collect()
    assert sorted((r.page_id or 0, r.text, r.kind or 0) for r in got) == [(0, "", 0), (1, "a", 2), (1, "a", 2)]
    assert density.extract(rows.limit(0)).count() == 0


# ------------------------------------------------------------------------------ archives
def test_archive_round_trip_and_revisits(spark):
    big, other = "x" * 1500, "é" * 600
    rows = spark.createDataFrame(
        [(1, "u", big), (2, None, big), (2, None, big), (3, "a\r\nb", None), (None, "z", big), (4, "q", "small"),
         (5, "q", "small"), (6, "q", other), (7, "q", other), (None, "n", "w" * 1200), (None, "n", "w" * 1200)],
        "page_id long, url string, html string")
    folder = shared_folder(spark, "test-warc")
    read = archive.read(spark, folder, archive.write(rows, folder)).collect()
    assert len(read) == 11
    assert len({r.record_id for r in read}) == 11
    kinds = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in read)
    assert kinds == sorted([(1, 1500, "revisit", 2), (2, 1500, "response", 0), (2, 1500, "revisit", 2), (3, 0, "response", 0),
                            (0, 1500, "revisit", 2), (4, 5, "response", 0), (5, 5, "response", 0), (6, 1200, "revisit", 7),
                            (7, 1200, "response", 0), (0, 1200, "response", 0), (0, 1200, "revisit", 0)])
    assert {bytes(r.payload) for r in read if r.payload} == {big.encode(), other.encode(), b"small", b"w" * 1200}
    assert archive.write(rows.limit(0), shared_folder(spark, "test-warc")).count() == 0


def test_archive_payloads_are_those_written(spark, pages):
    folder = shared_folder(spark, "test-warc")
    read = {r.page_id: r for r in archive.read(spark, folder, archive.write(pages, folder)).collect()}
    for r in pages.collect():
        found = read[r.page_id]
        assert found.record_type == "revisit" or bytes(found.payload) == r.html.encode()


def test_archive_starts_with_its_dictionary_and_detects_damage():
    records = [archive.build_record(i, f"http://x/{i}", (f"<p>page {i} " + "common words of a page " * 40).encode(), None, False)
               for i in range(200)]
    data = archive.build_archive(records)
    assert data[:4] == archive.DICTIONARY_MAGIC.to_bytes(4, "little")
    assert [r["page_id"] for r in archive.read_archive(data)] == list(range(200))
    with pytest.raises(Exception):
        list(archive.read_archive(data[:-5]))
    record = records[0]
    for bad in (record.replace(b"WARC/1.1", b"WARC/9.9"), record[:-1], record.replace(b"page 0", b"page 1"),
                record.replace(b"WARC-Date", b"X-Date"), record.replace(b"Content-Length: ", b"Content-Length: 1", 1)):
        with pytest.raises(ValueError):
            archive.parse_record(bad)


# ------------------------------------------------------------------------------ token files
@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))


def test_token_files(spark, docs, bpe):
    start, expected = 0, {}
    for r in docs.orderBy("doc_id").collect():
        ids = bpe.encode(r.text or "", add_special_tokens=False).ids + [0]
        expected[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op6_seekable_token_files(spark, SF).collect()}
    assert got == expected


def test_token_file_cases(spark, bpe):
    rows = spark.createDataFrame([(5, None, 1), (None, "a b", 1), (3, "", 1), (3, "x", 1), (3, "x", 1), (9, "long " * 50000, 1)],
                                 "doc_id long, text string, start int")
    folder = shared_folder(spark, "test-tokens")
    files = tokenfile.write(rows, folder, tokenizers.path("byte_bpe_50k.json"), file_bytes=100)
    got = sorted(tokenfile.read(spark, folder, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 3, 3, 3, 5, 9]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    names = [r.name for r in files.collect()]
    assert tokenfile.lookup(folder, names, {5, 9}) == {5: [0], 9: bpe.encode("long " * 50000, add_special_tokens=False).ids + [0]}
    empty = tokenfile.write(rows.limit(0), shared_folder(spark, "test-tokens"), tokenizers.path("byte_bpe_50k.json"))
    assert empty.count() == 0


class _Counting:
    def __init__(self, data):
        import io
        self.file, self.read_bytes, self.n = io.BytesIO(data), 0, len(data)

    def size(self):
        return self.n

    def seek(self, at):
        self.file.seek(at)

    def read(self, n):
        self.read_bytes += n
        return self.file.read(n)


def test_token_file_reads_only_what_is_asked_and_checks_it():
    payloads = [np.random.default_rng(i).integers(0, 50000, 2000).astype("<u4").tobytes() for i in range(50)]
    data = tokenfile.build_file(list(enumerate(payloads)), {"end": 0})
    source = _Counting(data)
    f = tokenfile.TokenFile(source)
    assert f.document(17) == payloads[17] and list(f.documents()) == payloads
    source = _Counting(data)
    tokenfile.TokenFile(source).document(3)
    assert source.read_bytes < len(data) / 10
    broken = bytearray(data)
    broken[int(f.offsets[8]) + 60] ^= 1
    with pytest.raises(Exception):
        tokenfile.TokenFile(_Counting(bytes(broken))).document(7)
    with pytest.raises(ValueError):
        tokenfile.TokenFile(_Counting(data[:-1]))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab cd  e.,'s\n\t!é日 09\xa0 \x1c")), max_size=40))
def test_word_wise_encoding_is_the_library_s(text):
    global _ENCODER
    if "_ENCODER" not in globals():
        with open(tokenizers.path("byte_bpe_50k.json")) as f:
            _ENCODER = tokenfile.Encoder(f.read())
    expected = _ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_ENCODER.payloads([text])[0], "<u4").tolist() == expected


@pytest.fixture
def handed(monkeypatch):
    """An encoder and the list of words that it hands to the tokenizer."""
    with open(tokenizers.path("byte_bpe_50k.json")) as f:
        encoder = tokenfile.Encoder(f.read())
    words, together = [], encoder._together

    def counted(some, *args):
        words.extend(some)
        return together(some, *args)
    monkeypatch.setattr(encoder, "_together", counted)
    return encoder, words


def _library(encoder, texts):
    return [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def _ids(encoder, texts):
    return [np.frombuffer(p, "<u4").tolist() for p in encoder.payloads(texts)]


def test_a_word_is_encoded_once_whatever_marks_are_behind_it(handed):
    encoder, words = handed
    texts = ["the stone, stone. stone### stone.%%% stone\nstone!! (stone) été&&&", None, "a  b", "", "a stone;\nthe été $$$ stone"]
    for _ in range(2):
        assert _ids(encoder, texts) == _library(encoder, texts)
    assert sorted(words) == sorted(["stone", "(stone", "été", "$$$"] + ["the", "stone", "a"])      # behind a space, after a line end


def test_words_in_use_stay_remembered(handed, monkeypatch):
    encoder, words = handed
    monkeypatch.setattr(tokenfile, "KEEP_WORDS", 40)
    for i in range(20):
        texts = ["x common, " + " ".join(f"w{i}o{k}" for k in range(30))]
        assert _ids(encoder, texts) == _library(encoder, texts)
        assert len(encoder.fresh) + len(encoder.stale) < 200
    assert words.count("common") == 1


def test_words_with_marks_and_added_tokens_beside_each_other(handed):
    encoder, _ = handed
    some = ["<|endoftext|>", "a<|endoftext|>", "<|endoftext|>,", "endoftext|>", "x>", "x|", "don't,", "it's", "'s,", "a'", "a_", "a_,", "_", ",",
            "é!!", "日,", "日", "1,", "1.5", "a,b.", "A,,,'", "\u0250,", "\u01c5!", "😀.", "ß)", "...", "e\u0301,", "\u200b,"]
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(some) + rng.choice([" ", "\n", ""], p=[0.7, 0.2, 0.1]) for _ in range(rng.integers(1, 12))).strip()
             for _ in range(2000)]
    assert _ids(encoder, texts) == _library(encoder, texts)


def test_rows_encoded_together_are_bounded_by_their_bytes():
    import pyarrow as pa
    texts = pa.array(["é" * 30, None, "", "b" * 200, "c" * 40, "d" * 60, "e"])
    assert list(tokenfile._runs(texts, 100)) == [(0, 3), (3, 1), (4, 2), (6, 1)]
    assert list(tokenfile._runs(texts.slice(2, 2), 100)) == [(0, 1), (1, 1)]
    assert list(tokenfile._runs(pa.array([], pa.string()), 100)) == []


# ------------------------------------------------------------------------------ SentencePiece
@pytest.fixture(scope="module")
def machines():
    with open(tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return pieces.compile_model(f.read())


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(spark, docs, library):
    got = {r.doc_id: r for r in queries.op8_sentencepiece_wfst(spark, SF).collect()}
    for r in docs.collect():
        assert list(got[r.doc_id].ids) == library.encode(r.text or "") and got[r.doc_id].round_trip


def test_pieces_cases(machines, library):
    texts = ["", " ", "a", "  a", "a  b   c", "\n\n x", "日本語 テスト", "🎉🎉 ok", "a▁b", "▁", "\x00a", "x" * 5000, "a\nb \n c"]
    for text in texts + ["x" + " " * k + "y" for k in range(40)]:
        assert machines.encode(text) == library.encode(text), repr(text)
        assert machines.decode(machines.encode(text)) == library.decode(library.encode(text)), repr(text)
    assert machines.encode(None) == []


def test_pieces_fuzz(machines, library):
    rng = np.random.default_rng(5)
    letters = list("abcdefgh tionerse    .,!?0123ABC\n\té日🎉▁")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(1, 30)))
        assert machines.encode(text) == library.encode(text), repr(text)


def test_pieces_of_long_runs(machines, library):
    rng = np.random.default_rng(6)
    for text in ("".join(map(chr, rng.integers(0x4E00, 0x9FA5, 5000))), "中文" * 2500, "".join(map(str, rng.integers(0, 10, 5000))),
                 "1" * 5000, "กข" * 2500, "🎉" * 5000, "  " + "中" * 5000 + " a1b2" * 1000, "a中1" * 1700):
        assert machines.encode(text) == library.encode(text), text[:20]
        assert machines.decode(machines.encode(text)) == text


def test_unigram_path_is_the_least():
    m = pieces.Machines(["<unk>", "a", "b", "ab", "abc", "c"], [0, 1.0, 1.0, 1.5, 5.0, 1.0], [2, 1, 1, 1, 1, 1], False, False, False)
    m.ids = {p: i for i, p in enumerate(m.pieces) if i}
    for p, i in m.ids.items():
        node = m.trie
        for ch in p:
            node = node.setdefault(ch, {})
        node[0] = i
    m.far = 15.0
    assert m.path("abc") == [3, 5] and m.path("aab") == [1, 3] and m.path("axb") == [1, 0, 2]


def test_piece_columns(spark, machines):
    rows = spark.createDataFrame([(1, "hello world", "x", 3), (1, None, "y", 4)], "doc_id long, text string, ids string, n int")
    model = tokenizers.path("piece_bpe_32k.model")
    got = pieces.encode(rows, model)
    assert got.columns == ["doc_id", "text", "n", "ids", "round_trip"]
    back = pieces.decode(got.drop("text"), model).collect()
    assert sorted((r.n, r.text) for r in back) == [(3, "hello world"), (4, "")]
    assert pieces.encode(rows.limit(0), model).count() == 0


# ------------------------------------------------------------------------------ quality rules
def test_blank_runs_are_linear():
    import time

    import sentencepiece
    path = tokenizer_file("piece_bpe_32k.model")
    with open(path, "rb") as f:
        machines = pieces.compile_model(f.read())
    text = "a" + " " * 100_000 + "b" + " " * 7
    began = time.process_time()
    got = machines.encode(text)
    assert time.process_time() - began < 5
    assert got == sentencepiece.SentencePieceProcessor(model_file=path).encode(text)


def test_files_are_read_back_in_many_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr("id as page_id", "concat('http://x/', id) as url", "repeat(cast(id as string), 500) as html")
    folder = str(tmp_path / "many")
    made = archive.write(rows, folder, archive_bytes=2000)
    assert made.count() >= 100
    back = archive.read(spark, folder, made, payloads=False).withColumn("task", F.spark_partition_id())
    assert back.count() == 400 and back.select("task").distinct().count() > 1
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('word ', 50) as text")
    files = tokenfile.write(docs, folder + "-ids", tokenizer_file("byte_bpe_50k.json"), file_bytes=200)
    assert files.count() >= 100
    back = tokenfile.read(spark, folder + "-ids", files).withColumn("task", F.spark_partition_id())
    assert back.count() == 400 and back.select("task").distinct().count() > 1


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t#é\x0b\xa0|")), max_size=120))
def test_counts(text):
    body = text.encode()
    assert quality.counts(text, body, body.split()) == brute_counts(text)


def test_quality_query(spark, docs):
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        x, expected = got[r.doc_id], brute_counts(r.text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == expected
        assert x.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (x.base_failed and x.kept)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.assess(docs, model).join(labels.filter("doc_id % 2 = 1").select("doc_id", "quality"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.97
    assert sum(r.kept for r in bad) / len(bad) < 0.3


def test_quality_cases(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = spark.createDataFrame([(1, text, "old"), (2, None, None), (None, "", ""), (1, text, "old"), (3, "same " * 40, "x")],
                                 "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(rows, none) is None
    one_kind = spark.createDataFrame([(1, 1), (1, 1), (9, 0), (2, None), (None, 0), (3, 7)], "doc_id long, quality int")
    assert quality.fit(rows, one_kind) is None
    got = quality.assess(rows, None).collect()
    assert sorted((r.n_words, r.kept) for r in got) == [(0, False), (0, False), (40, False), (40, True), (40, True)]
    assert quality.assess(rows.limit(0), None).count() == 0


def test_an_id_of_many_rows_is_fitted_once(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("case when id < 19990 then 5 else id end as doc_id", "concat('word ', id, ' and more') as text")
    labels = spark.createDataFrame([(5, 1), (19990, 0), (19991, 1), (19992, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda data, y, *_: seen.append((len(data), sorted(y))))
    quality.fit(rows, labels)
    assert seen == [(4, [0, 0, 1, 1])]


def test_long_texts_send_a_bounded_part_to_the_fit():
    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(97, 123, 200_000))).replace("q", " ")
    where, value = quality._sparse(text, text.encode().split(), quality.BITS, 5000)
    whole = quality._sparse(text, text.encode().split(), quality.BITS, 1 << 30)
    assert len(where) == 5000 and set(where) <= set(whole[0].tolist()) and value.sum() == pytest.approx(whole[1].sum(), rel=0.2)


def test_scores_are_those_of_the_listed_features():
    """The probability by loops over words and characters."""
    rng = np.random.default_rng(4)
    model = quality.Model(rng.normal(size=1 << quality.BITS).astype(np.float32), 0.7, -0.2)
    wide = (1 << 64) - 1

    def weight(x, family):
        return float(model.weights[((x + (family << 40)) * 0x9E3779B97F4A7C15 & wide) >> (64 - quality.BITS)])
    for text in ("one two two three éa", "a", "", "日本 日本 x", "ab " * 30):
        words, raw = text.encode().split(), 0.0
        h = [zlib.crc32(w) for w in words]
        c = [ord(x) for x in text]
        three = [c[i] << 42 | c[i + 1] << 21 | c[i + 2] for i in range(len(c) - 2)]
        four = [(three[i] * 0x100000001B3 + c[i + 3]) & wide for i in range(len(c) - 3)]
        pairs = [0 if a == b else (a * 0x100000001B3 + b) & wide for a, b in zip(h, h[1:])]
        for family, grams in enumerate((h, pairs, three, four), 1):
            if grams:
                raw += sum(weight(g, family) for g in grams) / len(grams)
        assert model.probability(text, words) == pytest.approx(1 / (1 + math.exp(-(0.7 * raw - 0.2))), rel=1e-4)


def test_calibration_follows_the_labels():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * z - 1)))).astype(float)
    slope, offset = quality.platt(z, y)
    assert abs(slope - 2) < 0.3 and abs(offset + 1) < 0.2


def test_files_are_reached_by_the_folder_s_scheme(spark):
    assert open_folder("file:/tmp/x")[1] == "/tmp/x" and open_folder("/tmp/x")[1] == "/tmp/x"
