"""Pages against the standard library's parser, and texts that made patterns slow."""

import html
import json
import random
import time
from html.parser import HTMLParser

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from signalbook.llm import packing, warc

ADDRESSES = {"href", "src", "action", "cite", "background", "longdesc", "formaction"}


class Reader(HTMLParser):
    """Text, title and links by the standard library's events."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.parts, self.title, self.links, self.hidden, self.titled = [], None, [], [], False
        self.feed(page)
        self.close()
        lines = (" ".join(x.split()) for x in "".join(self.parts).split("\n"))
        self.text = "\n".join(x for x in lines if x)

    def handle_starttag(self, tag, attrs):
        for key, value in attrs:
            if key in ADDRESSES or (key, tag) in {("poster", "video"), ("data", "object")}:
                self.links.append((f"{tag.upper()}@/{key}", (value or "").strip()))
            elif key == "srcset":
                self.links += [(f"{tag.upper()}@/{key}", c.split()[0]) for c in value.split(",")]
        if tag in warc._BLOCKS and not self.hidden:
            self.parts.append("\n")
        if tag in warc._HIDDEN:
            self.hidden.append(tag)
            self.parts.append(" ")
        self.titled = tag == "title"

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()
        elif tag in warc._BLOCKS and not self.hidden:
            self.parts.append("\n")
        self.titled = False

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.titled:
                self.title = (self.title or "") + data

    def handle_comment(self, data):
        self.parts.append(" ")


def page(draw):
    """A page that is well formed, with everything that is awkward inside."""
    word = lambda: draw.choice(["one", "two &amp; three", "x &lt; y", "größe", "a > b", "5", "&nbsp;&copy;", "  gap\n\t"])
    value = lambda: html.escape(draw.choice(["/a?b=1&c=2", "p.html", "x > y", "it's", "", " pad "]))

    def attribute():
        key = draw.choice(["href", "src", "title", "class", "data-src", "cite", "poster", "SRC", "disabled", "srcset"])
        if key == "disabled":
            return key
        if key == "srcset":
            return 'srcset="a.png 1x, b.png 2x"'
        return draw.choice([f'{key}="{value()}"', f"{key} = '{value()}'", f"{key}=bare{draw.randint(0, 9)}"])

    def element(depth):
        name = draw.choice(["p", "div", "a", "b", "span", "li", "object", "video", "td", "i"])
        inside = "".join(piece(depth - 1) for _ in range(draw.randint(0, 3)))
        attributes = {a.split("=")[0].strip().lower(): a for a in (attribute() for _ in range(draw.randint(0, 3)))}
        return f"<{' '.join([name, *attributes.values()])}>{inside}</{name}>"

    def piece(depth):
        kind = draw.random()
        if depth and kind < 0.5:
            return element(depth)
        if kind < 0.6:
            return draw.choice(["<br>", "<hr/>", '<img src="i.png" alt="&gt;">', "<BR />"])
        if kind < 0.65:
            return draw.choice(["<!-- <a href=no> -->", "<script>if (a<b) '<a href=no>'</script>", "<style>p > a {}</style>"])
        if kind < 0.7:
            return draw.choice(["<noscript>hid <img src=seen.png> den</noscript>", "<template><p>t</p></template>"])
        return word()

    body = "".join(piece(3) for _ in range(8))
    return f"<!DOCTYPE html><html><head><title> T &amp; {word()}</title></head><body>{body}</body></html>"


def test_pages_as_by_the_standard_parser():
    draw = random.Random(8)
    for _ in range(300):
        source = page(draw)
        got, expected = warc.Page(source), Reader(source)
        assert got.text == expected.text, source
        assert got.title == (expected.title or "").strip(), source
        assert [(x["path"], x["url"]) for x in got.links] == expected.links, source


def test_markup_that_is_not_closed():
    assert warc.Page("a <!-- b").text == "a" and warc.Page("a <script> b").text == "a"
    assert warc.Page("a <b c").text == "a" and warc.Page("a </b c").text == "a"
    open_title = warc.Page("<title>x <p>y</p>")
    assert open_title.title is None and open_title.text == "x\ny"
    assert warc.Page("").text == "" and warc.Page("1 < 2 <3").text == "1 < 2 <3"
    quote = warc.Page("<a href='x>y")
    assert [x["url"] for x in quote.links] == ["'x"] and quote.text == "y"
    refresh = "<meta http-equiv=refresh content=\"5; URL='next.html'\"><base href=/b/>"
    assert [x["url"] for x in warc.Page(refresh).links] == ["next.html", "/b/"]


JUNK = ["<a ", "<title>", "<b", "<script ", "<script>", '<a href="', "<noscript>", "<a =", "<!--", "<", "</", "<a x='y\"", "<style></style>", "&amp"]


@pytest.mark.parametrize("junk", JUNK)
def test_time_grows_with_the_page(junk):
    begin = time.perf_counter()
    warc.Page(junk * (5_000_000 // len(junk)))
    assert time.perf_counter() - begin < 10  # a quadratic scan takes hours


def test_derivatives_of_long_and_clashing_rows(spark):
    long = "<p>word</p>" * 300_000
    pages = spark.createDataFrame([(1, "u", long), (2, "u", "<a " * 500_000)], "page_id long, url string, html string")
    responses = warc.responses_of(pages, "2024-01-01T00:00:00Z").select("*", F.lit("old").alias("id"), F.lit("old").alias("content"))
    got = {(r.page_id, r.record_type): r for r in warc.derivatives(responses, "page_id").collect()}
    assert len(got) == 4 and got[1, "conversion"].content.count("word") == 300_000
    assert got[2, "conversion"].content == ""
    assert json.loads(got[2, "metadata"].content)["Envelope"]["Payload-Metadata"]


# --- runs of white space in packing ----------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    ranks = packing.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("n, rest", [(2_000_000, "{}"), (1_000_000, "a{}b"), (1_000_000, "{}<|endoftext|>{}")])
def test_long_blanks_have_the_ids_of_the_vocabulary(tokenizers, n, rest):
    for blank in " ", "\t", "　":
        text = rest.format(blank * (n // 4 if blank == "　" else n), " " * 300)
        assert packing.encoded(tokenizers[0], text) == tokenizers[1].encode(text, add_special_tokens=False).ids


def test_runs_about_the_limit(tokenizers):
    draw = random.Random(6)
    for _ in range(200):
        parts = []
        for _ in range(draw.randint(1, 5)):
            parts.append(draw.choice([" ", "\n", "\t ", "\xa0", "\r\n", "\x1c", "\x85"]) * draw.choice([1, 2, 128, 255, 256, 257, 400]))
            parts.append(draw.choice(["word", " it's", "12", "!?", "<|endoftext|>", "größe", ""]))
        text = "".join(parts[draw.randint(0, 1) :])
        assert packing.encoded(tokenizers[0], text) == tokenizers[1].encode(text, add_special_tokens=False).ids, repr(text)


def test_a_blank_document_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 2_000_000), (2, "x")], "doc_id long, text string")
    got = packing.packed_documents(docs).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 2_000_001
    assert all(r.offset + r.length <= 2048 for r in got)
