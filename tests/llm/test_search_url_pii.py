import datetime
import random
import re
from decimal import Decimal

import numpy as np
import pytest

from linkloom.llm import pii, queries, topk_search, url_filter


def brute_top(rows, asked, k):
    out = []
    for q, v in asked:
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [5, 300, 10**7])
def test_top_k(spark, scale):
    rng = np.random.default_rng(scale)
    rows = [(i, [int(x) for x in rng.integers(-scale, scale + 1, 6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(2000, [0] * 6), (2001, [scale]), (2002, [])]
    asked = rows[:300:25] + [rows[-1], rows[-3], rows[300]]
    df = lambda r: spark.createDataFrame(r, "vec_id long, v array<long>")
    got = topk_search.top_k(df(rows), df(asked + asked[:2]), 10, tile_vectors=64, tile_queries=4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, asked, 10)
    assert topk_search.top_k(df(rows[:3]), df(asked[:1]), 10).count() == 2
    assert topk_search.top_k(df(rows).limit(0), df(asked), 10).count() == topk_search.top_k(df(rows), df(asked).limit(0), 10).count() == 0


def test_the_walk_stops_early():
    rng = np.random.default_rng(3)
    matrix = rng.normal(0, 300, (5000, 2)).round()
    read = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            read.append(len(self))
            return np.asarray(self) @ other

    lists = topk_search.Lists(np.arange(5000), matrix)
    lists.matrix = matrix.view(Counted)
    rows, scores = lists.top(np.array([100.0, 50.0]), -1, 10)
    assert sum(read) < 2500 and [int(s) for s in scores] == sorted((int(x) for x in matrix @ [100.0, 50.0]), reverse=True)[:10]


def test_vectors_left_out(spark):
    rows = [(1, [0.5, -0.25]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [])]
    got = topk_search.scaled_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted((r.vec_id, r.v) for r in got.collect()) == [(1, [512, -256]), (6, [])]


URLS = [
    (1, "http://Ab.COM/x?y"), (2, "https://example.com/en/1"), (3, "https://www.example.com/en/"), (4, "https://m.www.example.com/en/z#q"), (5, "http://a.net/es/1/2"), (6, "http://net/fr/"), (7, "http://b.net/de/1"),
    (8, None), (9, "no scheme.com/x"), (10, "http://com"), (11, "http://xcom/"), (12, "http://evilexample.com/en/"), (13, "//x.com/"), (14, "http://a.com://b/c"), (15, "http://É.com/É"), (16, ""), (16, ""), (None, "http://a.net/es/"), (17, "http://h.org/" + "/".join("abcdefghij") + "/1"),
]


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for r, v in queries.URL_RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules(spark):
    df = spark.createDataFrame([(*u, "clash") for u in URLS], "page_id long, url string, host string")
    got = url_filter.judge_urls(df, queries.URL_RULES).collect()
    assert len(got) == len(URLS)
    want = {i: brute_rule(u) for i, u in URLS}
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert url_filter.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_templates_generalise_and_reject(spark):
    rules = [("h.net/bad/", "block"), ("h.net/good/", "allow")]
    rows = [(i, f"http://h.net/bad/{i}") for i in range(60)] + [(100 + i, f"http://h.net/good/p{i}.html") for i in range(60)] + [(200 + i, f"http://h.net/s/word{chr(97 + i % 26)}{chr(97 + i // 26)}/x") for i in range(200)]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[0].template == "/bad/{number}" and got[0].blocked_share > 0.9
    assert got[100].template == "/good/{mixed}.html" and got[100].blocked_share < 0.1
    assert got[200].template.startswith("/s/{rare}") and got[200].verdict == "allow"


def brute_templates(forms, config):
    """{(host, form): template} of [(host, form, by_rule)], by plain recursion over the definition."""
    ways = lambda p: "end" if p is None else p[: p.index("}") + 1] if p.startswith("{") else "file" if "." in p else "word"
    out = {}

    def z(x1, n1, x2, n2):
        if not n1 or not n2:
            return 0
        p = (x1 + x2) / (n1 + n2)
        v = p * (1 - p) * (1 / n1 + 1 / n2)
        return abs(x1 / n1 - x2 / n2) / v**0.5 if v > 0 else 0

    def alike(g, b):
        cells = [(g["w"].get(k, 0), b["w"].get(k, 0)) for k in {*g["w"], *b["w"]}]
        x, y = (b["n"] / g["n"]) ** 0.5, (g["n"] / b["n"]) ** 0.5
        chi = sum((v * x - w * y) ** 2 / (v + w) for v, w in cells)
        return chi <= url_filter.CHI_SQUARE[len(cells) - 1] + 1e-9 and z(g["l"], g["n"], b["l"], b["n"]) <= config.z and z(g["b"], g["l"], b["b"], b["l"]) <= config.z

    def grow(host, members, level, prefix):
        by = {}
        for parts, label in members:
            if len(parts) <= level:
                out[host, "/".join(parts)] = prefix
            else:
                by.setdefault(parts[level], []).append((parts, label))
        total, words, steps = sum(map(len, by.values())), [], {}
        for part, own in by.items():
            if part.startswith("{"):
                steps[part] = part
            elif len(own) < config.least_rows or len(own) < config.least_share * total:
                steps[part] = "{rare}"
            else:
                w = {}
                for parts, _ in own:
                    k = ways(parts[level + 1] if len(parts) > level + 1 else None)
                    w[k] = w.get(k, 0) + 1
                words.append({"part": part, "n": len(own), "l": sum(x is not None for _, x in own), "b": sum(x == "block" for _, x in own), "w": w, "parts": [part]})
        groups = []
        for b in sorted(words, key=lambda b: (-b["n"], b["part"])):
            g = next((g for g in groups if alike(g, b)), None)
            if g is None:
                groups.append(b)
            else:
                g.update(n=g["n"] + b["n"], l=g["l"] + b["l"], b=g["b"] + b["b"], w={k: g["w"].get(k, 0) + b["w"].get(k, 0) for k in {*g["w"], *b["w"]}}, parts=g["parts"] + b["parts"])
        for g in groups:
            steps |= {p: "{~" + g["part"] + "}" if len(g["parts"]) > 1 else g["part"] for p in g["parts"]}
        joined = {}
        for part, own in by.items():
            joined.setdefault(steps[part], []).extend(own)
        for step, own in joined.items():
            going = sum(len(parts) > level + 1 for parts, _ in own)
            if going < config.least_rows:
                for parts, _ in own:
                    rest = [p if p.startswith("{") else "{rare}" for p in parts[level + 1 :]]
                    out[host, "/".join(parts)] = "/".join([prefix + "/" + step, *rest])
            else:
                grow(host, own, level + 1, prefix + "/" + step)

    hosts = {}
    for host, form, label in forms:
        hosts.setdefault(host, []).append((tuple(form.split("/")) if form else (), label))
    for host, members in hosts.items():
        grow(host, members, 0, "")
    return out


def test_templates_equal_brute_force(spark):
    rng, rows = random.Random(8), []
    for host in ("a.net", "b.net"):
        for _ in range(1500):
            first = rng.choice(["news", "blog", "shop", "bad", "good", "x", "y" + str(rng.randrange(40)), "q" + chr(97 + rng.randrange(26)) * 2])
            tail = [rng.choice(["{number}", "{mixed}", "item.html", "word", "more", "{hex}"]) for _ in range(rng.randrange(4) if first != "shop" else 1)]
            rows.append((host, "/".join([first, *tail]) if rng.random() > 0.01 else "", "block" if first == "bad" else "allow" if first == "good" else rng.choice([None, None, "block"]) if first == "x" else None))
    df = spark.createDataFrame(rows, "host string, form string, by_rule string")
    got = {(r.host, r.form): r.template for r in url_filter.path_templates(df).collect()}
    assert got == brute_templates(rows, url_filter.TemplateConfig())


def test_urls_without_rule_are_judged_by_their_node(spark):
    """Spam sections that rules name in part: what no rule fits is blocked with them, a clean section stays."""
    rules = [("h.net/win/a", "block"), ("h.net/win/b", "block"), ("h.net/win/c", "block"), ("h.net/doc/a", "allow")]
    rows = [(i, f"http://h.net/win/{'abcd'[i % 4]}{'xyz'[i % 3]}offer/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://h.net/doc/{'ab'[i % 2]}page/{i}.html") for i in range(200)] + [(2000 + i, f"http://h.net/team/{i}") for i in range(100)]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    unruled = [r for r in got.values() if r.rule is None]
    assert {r.verdict for r in unruled if r.path.startswith("/win/")} == {"block"}
    assert {r.verdict for r in unruled if not r.path.startswith("/win/")} == {"allow"} and 0.5 < got[2000].blocked_share < 0.9


def test_deep_branches_are_told_apart(spark):
    rules = [("h.net/2024/05/news/all/spam/", "block"), ("h.net/2024/05/news/all/ok/", "allow")]
    rows = [(1000 * y + 100 * k + i, f"http://h.net/{2024 + y}/05/news/all/{w}/x/{i}") for y in (0, 1) for k, w in enumerate(("spam", "ok")) for i in range(60 - 40 * y)]
    deep = "/".join(["a"] * 40)
    rows += [(5000 + i, f"http://t.org/{deep}/{i}") for i in range(8)] + [(6000, "http://t.org/a/b/c/d/e7/f.html"), (6001, "http://t.org/")]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(got) == len(rows) and all(r.template.count("/") == max(1, r.path.count("/")) or r.path == "/" for r in got.values())
    for i in range(20):
        assert (got[1000 + i].verdict, got[1100 + i].verdict) == ("block", "allow")
    assert "/spam/" in got[1000].template and "/ok/" in got[1100].template and got[1000].blocked_share > 0.9 > 0.1 > got[1100].blocked_share
    assert got[6000].template.endswith("/{rare}/{rare}/{rare}/{mixed}/{rare}") and got[5000].template.endswith("/{number}") and got[6001].template == ""


def test_url_queries(spark, small):
    rows = queries.op1_url_filters(spark, small).collect()
    want = {r.page_id: brute_rule(r.url) for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(rows) == len(want)
    for r in rows:
        assert (r.host, r.path, r.rule) == want[r.page_id][:3] and r.verdict == (want[r.page_id][3] or r.verdict)


VALUES = ["anna.b7@mail3.example.com", "+1 (988) 555-2485", "4041894974608795", "42.144.35.254", "2021-02-28", "28.02.2021", "02/28/2021", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "+4915112345678", "4041 8949 7460 8795"]


def test_pseudonyms_keep_format_and_links():
    maker, other = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"l")
    for value in VALUES:
        new, spans = maker.replaced(f"See {value}, and {value}.")
        kind = spans[0][0]
        pseudonym = maker.pseudonym(kind, value)
        assert new == f"See {pseudonym}, and {pseudonym}." and pseudonym != value, value
        assert maker.pseudonym(kind, pseudonym, back=True) == value
        assert other.pseudonym(kind, value) != pseudonym
        if kind not in ("ip",):
            assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", pseudonym))) == re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", value)))
        assert maker.replaced(pseudonym)[1], "the pseudonym is valid in its format"
    days = [maker.pseudonym(k, v) for k, v in (("isodate", "2021-02-28"), ("dotdate", "28.02.2021"), ("slashdate", "02/28/2021"))]
    parsed = [datetime.date.fromisoformat(days[0]), datetime.datetime.strptime(days[1], "%d.%m.%Y").date(), datetime.datetime.strptime(days[2], "%m/%d/%Y").date()]
    assert len(set(parsed)) == 1


DATES = ["28/02/2021", "2021/02/28", "2021/2/8", "Jan 5, 2021", "March 15, 2021", "5 January 2021", "15 Mar 2021", "9.9.2021", "5/6/2021", "May 1, 2020"]


def test_dates_of_each_form_keep_form_and_width():
    maker = pii.Pseudonyms(b"k")
    for value in DATES:
        new, spans = maker.replaced(f"on {value}; x")
        kind, start, end = spans[0]
        pseudonym = new[3:-3]
        assert (start, end) == (3, 3 + len(value)) and pseudonym != value
        assert re.sub(r"\d", "0", re.sub("[A-Z][a-z]+", "M", pseudonym)) == re.sub(r"\d", "0", re.sub("[A-Z][a-z]+", "M", value)), (value, pseudonym)
        assert maker.pseudonym(kind, pseudonym, back=True) == value
    for clean in ("version 1.2.3.4", "v1.2.3.4", "31/02/2021", "2021/13/45", "Smarch 5, 2021", "32 May 2021"):
        assert maker.replaced(clean) == (clean, []), clean


def test_permutations_of_each_date_form_are_bijections(monkeypatch):
    """Every valid text of a form becomes another of the same form, and no two become one."""
    maker, first = pii.Pseudonyms(b"k"), datetime.date(2019, 1, 1).toordinal()
    monkeypatch.setattr(pii, "_FIRST_DAY", first)
    monkeypatch.setattr(pii, "_LAST_DAY", first + 1095)
    days = [datetime.date.fromordinal(first + i) for i in range(1096)]
    forms = {
        "dotdate": [f"{d.day}.{d.month}.{d.year}" for d in days if d.day < 10 and d.month < 10],
        "slashdate": [f"{d.day:02}/{d.month:02}/{d.year}" for d in days if d.day > 12],
        "ymddate": [f"{d.year}/{d.month}/{d.day:02}" for d in days if d.month < 10],
        "namedate": [f"{pii.MONTHS[d.month - 1]} {d.day}, {d.year}" for d in days if d.day < 10 and d.month != 5],
    }
    for kind, texts in forms.items():
        assert {maker.pseudonym(kind, x) for x in texts} == set(texts), kind
    assert sorted(maker.permuted(i, 1000, "t") for i in range(1000)) == [*range(1000)]


NEXT = ["12", "5", "2024", "48451681144", "190.137.223.204", "7536784127813050", "555-123-4567", "2021-02-28", "x@mail.example.com"]


def test_values_next_to_numbers():
    maker = pii.Pseudonyms(b"k")
    for value in [*VALUES, "+1 (826) 555-4081", "555-123-4567", "+49 30 12345678", "(030) 12345678", "+33 1 23 45 67 89", "BE68 5390 0754 7034", "7536784127813050"]:
        kind, start, end = maker.replaced(f"See {value}, x")[1][0]
        assert (start, end) == (4, 4 + len(value)), value
        for other in NEXT:
            text = f"See {value} {other} and {value}, {other} {value} x"
            new, spans = maker.replaced(text)
            assert value not in new, (text, new)
            assert new.startswith(f"See {maker.pseudonym(kind, value)} ") or value == "+49 30 12345678" or value[:3] in ("(03", "+49", "+33"), (text, new)
            assert all(maker.pseudonym(k, text[a:b]) is not None for k, a, b in spans)
        for sign in "-.":
            if kind == "ip" or (kind, sign) == ("email", "."):
                continue
            assert value not in maker.replaced(f"See {value}{sign}12 x")[0], value


def test_planted_values_beside_numbers_go(spark):
    rows = [(1, "an 7536784127813050 4845168114407329 e"), (2, "des +1 (826) 555-4081 190.137.223.204 du"), (3, "tel +49 30 12345678 fax")]
    got = {r.doc_id: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    assert [[(s.kind, rows[i - 1][1][s.start : s.end]) for s in got[i].spans] for i in (1, 2, 3)] == [
        [("card", "7536784127813050"), ("card", "4845168114407329")],
        [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")],
        [("phone", "+49 30 12345678")],
    ]


@pytest.mark.parametrize("text", ["4041894974608796", "2021-02-30", "300.1.1.1", "1.2.3", "666-12-1234", "GB82 WEST 1234 5698 7654 33", "v 12 34", "a@b", "price 3,000.50 in 2021", "9.9. and 12."])
def test_invalid_values_stay(text):
    assert pii.Pseudonyms(b"k").replaced(text) == (text, [])


def test_feistel_is_a_permutation():
    maker = pii.Pseudonyms(b"k")
    for size in (1, 2, 7, 100, 1000):
        image = [maker.permuted(x, size, "t") for x in range(size)]
        assert sorted(image) == [*range(size)] and [maker.permuted(y, size, "t", back=True) for y in image] == [*range(size)]


def test_pseudonymised_rows(spark, small):
    rows = [(1, None, "c"), (2, "", "c"), (None, VALUES[0], "c"), (3, VALUES[1] + " " + "x" * 300_000, "c"), (3, VALUES[1], "c")]
    got = pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string, spans string"), b"k").collect()
    assert sorted((r.doc_id or 0, len(r.spans), r.text is None) for r in got) == [(0, 1, False), (1, 0, True), (2, 0, False), (3, 1, False), (3, 1, False)]
    found = queries.op9_pii_pseudonyms(spark, small).collect()
    original = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in found:
        assert (r.text == original[r.doc_id]) == (r.n_replaced == 0)
        for s in r.spans:
            assert original[r.doc_id][s.start : s.end] not in r.text
    assert Decimal(sum(r.n_replaced for r in found)) > 0
