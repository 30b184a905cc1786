"""Page text, chat formatting and token counts."""

import hashlib
import math

import pytest

from tripmill.llm import chat, html_text, token_counts
from tripmill.llm.queries import tokenizer_file

PAGE = """<html><head><title>T</title></head><body><header><div class="logo">Site</div></header>
<nav><ul><li><a href="/x">x</a></ul></nav><div id="sidebar"><p>Popular stories today are many.</p></div>
{open}<h1>Title</h1><p>First long paragraph of &quot;text&quot; here, with <a href=x>a link</a> in it.
<p>Second&nbsp;one.<div class="ad">Buy this now, it is really good for you.</div><script>var t="</p>";</script>
{close}<div class="comments"><p>I really liked this article, said a reader.</p></div>
<form>Subscribe</form><footer>(c)</footer></body></html>"""
TEXT = 'Title\n\nFirst long paragraph of "text" here, with a link in it.\n\nSecond one.'


def test_page_text(spark):
    marked = PAGE.format(open="<article>", close="</article>")
    plain = PAGE.format(open='<div class="content">', close="</div>")
    rows = [(1, "u", marked), (2, "u", None), (3, None, ""), (4, "u", "<p>a <3 b"), (5, "u", plain)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id bigint, url string, html string")
    found = html_text.extract(pages).collect()
    assert len(found) == 6
    by_id = {r.page_id: r for r in found}
    assert by_id[1].text == TEXT and by_id[1].n_chars == len(TEXT) and by_id[5].text == TEXT
    assert by_id[2].text == by_id[3].text == ""
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ('<p title="abc>five six</p><p>seven</p>', ["five six", "seven"]),
    ("<p title='abc>five six", ["five six"]),
    ('<p>one</p><p class="a', ["one"]),
    ('<p>one<br title="x>two</p>', ["one two"]),
    ('<p title="a>b" lang="c>five</p>', ["five"]),
    ("<p don't>five</p><p>it's</p>", ["five", "it's"]),
    ("<p title = 'a>b' x=\"c>d\">five</p>", ["five"]), ("<p x==y='>five</p>", ["five"]),
    ("<p>3 < 4 and a<b>c</b></p>", ["3 < 4 and ac"]),
    ("<", ["<"]), ("", []),
])
def test_broken_markup_never_becomes_text(page, want):
    assert [n.text for n in html_text.tree_of(page) if n.tag == "#text"] == want


def test_very_long_broken_page_is_read_in_one_pass():
    page = '<div><p title="x>word</p></div>' + "<p>'plain' \"word\"</p>" * 20_000 + '<p id="'
    found = [n.text for n in html_text.tree_of(page) if n.tag == "#text"]
    assert found == ["'plain' \"word\""] * 19_999  # the first opens inside the quotes


def test_messages_equal_exact_marginals():
    nodes = html_text.tree_of("<div><p>one two</p><p>three</p></div><nav>four</nav>")
    weights, edge = html_text.PRIOR, html_text.PRIOR_EDGE
    own = [sum(weights.get(f, 0) for f in fs) for fs in html_text.features(nodes)]
    total, on = 0.0, [0.0] * len(nodes)
    for states in range(1 << len(nodes)):
        s = [states >> k & 1 for k in range(len(nodes))]
        p = sum(u for u, x in zip(own, s) if x)
        p += sum(edge[s[n.parent]][s[k]] for k, n in enumerate(nodes) if k)
        total += math.exp(p)
        for k, x in enumerate(s):
            on[k] += x * math.exp(p)
    found = html_text.marginals(nodes, weights, edge)
    assert all(math.isclose(a, b / total, rel_tol=1e-9) for a, b in zip(found, on))


def test_chat_round_trip(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 1, "assistant", said), (1, 0, "user", said), (2, 0, "ass\nis\\tant<|", "a<\\|b"),
            (2, None, None, None), (3, 0, "assistant", ""), (None, 5, "assistant", "x")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    found = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, schema)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (2, len(said), sha(said))
    assert found[2].turns_sha256 == sha("\n\nass\nis\\tant<|\na<\\|b\n") and found[2].loss_chars == 0
    assert found[3].loss_sha256 == sha("") and found[None].n_turns == 1
    turns = chat.render_turns(spark.createDataFrame(rows, schema)).filter("conv_id = 1").collect()
    last = max(turns, key=lambda r: r.turn_no)
    assert chat.unescape(last.formatted[last.loss_start : last.loss_end]) == said


@pytest.mark.parametrize("source", ["{{ a.__class__ }}", "{% import os %}", "{{ a | nothing }}",
                                    "{% for x in y %}", "{{ a.b() }}", "{{ 'a }}", "{{ a"])
def test_sandbox_refuses(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_constants_are_folded():
    assert chat.fold(chat.parse("a{{ 'b' ~ ('c' | upper) }}{% if 1 == 2 %}x{% else %}d{% endif %}")) == (
        "const", "abCd")


def test_token_counts(spark):
    v = token_counts.vocabulary(tokenizer_file("piece_bpe_32k.model"))

    def brute(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            ways = []
            for start in range(end):
                if (p := v.scores.get(word[start:end])) is not None:
                    ways.append((best[start][0] + p, -best[start][1] + -1))
            if word[end - 1] not in v.scores:
                p, k = v.character(word[end - 1])
                ways.append((best[end - 1][0] + p, -best[end - 1][1] - k))
            score, tokens = max(ways)
            best.append((score, -tokens))
        return best[-1][1]

    texts = ["the thing thinking therefore", "", None, "日本 é🙂 the", "a b\tc"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = tokenizer_file("piece_bpe_32k.model")
    for r in token_counts.count_tokens(rows, path).collect():
        words = [w for w in token_counts._words((texts[r.doc_id] or "").encode())]
        assert (r.n_words, r.n_tokens) == (len(words), sum(map(brute, words)))
