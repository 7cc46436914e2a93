"""Main text against the text that pages were made of."""

import random

from fieldlens.llm import wrapper


def page(host, body, extra=""):
    return (f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Home</a></li></ul></nav>'
            f'<div class="top-line">Welcome to {host}</div>{extra}<div class="text">{body}</div><div class="bottom">All about {host} since 1999</div>'
            f'<div class="comments"><p>nice</p></div><footer>&copy; {host}</footer></body></html>')


def test_slots_of_unmarked_pages(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(60):
        host = f"h{i % 3}.example.com"
        blocks = [" ".join(rng.choices(["alpha", "beta", "gamma", "é"], k=rng.randrange(3, 30))) + f" {i} {k}" for k in range(rng.randrange(1, 9))]
        rows.append((i, f"https://{host}/p{i}?x=1", page(host, "".join(f"<p><b>{b}<br>" if rng.random() < .3 else f"<p>{b}</p>" for b in blocks))))
        want[i] = "\n\n".join(blocks)
    rows += [(100, "https://h0.example.com/", None), (101, None, "<article><p>a &amp; b &#233;</p> tail <script>x</script>\n<p>c\n d&nbsp;e</article>"), (102, "", ""),
             (103, "http://one.example.org/", "<main><h1>Head</h1><ul><li>x<li>y</ul><form>f</form><aside>z</aside></main>"), (104, "u", "plain < text & more")]
    want |= {100: "", 101: "a & b é\n\ntail\n\nc d e", 102: "", 103: "Head\n\nx\n\ny", 104: "plain < text & more"}
    got = {r.page_id: (r.text, r.n_chars) for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {k: t for k, (t, _) in got.items()} == want and all(len(t) == n for t, n in got.values())


def test_copies_are_no_template(spark):
    same = page("a", "<p>only text of this host</p>")
    rows = [(i, "http://a/", same) for i in range(5)]
    assert {r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {
        "Welcome to a\n\nonly text of this host\n\nAll about a since 1999"}


def test_matching_is_the_best(spark):
    rng = random.Random(4)

    def tree(depth):
        return "<{0}>{1}</{0}>".format(rng.choice("uvw"), "".join(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else "")

    def full(a, b):
        if a.key != b.key:
            return 0
        m = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids):
            for j, y in enumerate(b.kids):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + full(x, y))
        return 1 + m[-1][-1]

    for _ in range(60):
        a, b = wrapper.parse(tree(4)), wrapper.parse(tree(4))
        assert wrapper.score(a, b) == full(a, b) == sum(1 for _ in wrapper.aligned(a, b))


def test_deep_and_broken_pages():
    assert wrapper.main_text("<div>" * 3000 + "x" + "</p></div>" * 10, None) == "x"
    assert wrapper.main_text("<p class='a>b</p><!-- never closed", None) == "b"
    assert wrapper.main_text("<article><p>1<p>2<table><tr><td>3<td>4</table>", None) == "1\n\n2\n\n3\n\n4"


def test_small_hosts_and_late_template_parts(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(3 * 30 + 60):
        host = f"s{i % 30}.example.com" if i < 90 else "big.example.com"
        block = " ".join(rng.choices(["alpha", "beta", "gamma"], k=8)) + f" {i}"
        extra = "<div class=\"zz\">Closed for the holidays</div>" if i >= 90 and i % 3 == 0 else ""
        body = f"<p>{block}</p>" + ("<p>Quoted twice.</p>" if i in (91, 92, 94, 95) else "")
        rows.append((i, f"https://{host}/p{i}", page(host, body, extra)))
        want[i] = block + ("\n\nQuoted twice." if i in (91, 92, 94, 95) else "")
    rows += [(1000 + k, "https://s0.example.com/copy", rows[0][2]) for k in range(3)]
    want |= {1000 + k: want[0] for k in range(3)}
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == want
