import random

import cases
import numpy as np
import pytest
import oracle

from cadenza.llm import licenses, secret_scan, suite, url_filters


def contained(text, template):
    here, wanted = set(licenses.shingles_of(text).tolist()), set(licenses.shingles_of(template).tolist())
    return bool(wanted) and len(here & wanted) / len(wanted) >= 0.8


def license_texts():
    rng, out = random.Random(4), []
    for i in range(120):
        parts = [cases.prose(i, rng.randrange(0, 400))]
        for _, template in rng.sample(licenses.TEMPLATES, rng.randrange(0, 3)):
            words = template.split()
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = "other"
            parts += [" ".join(words).upper(), cases.prose(i + 500, rng.randrange(0, 50))]
        out.append("\n".join(parts))
    return out


def test_licenses_equal_brute_force(spark):
    texts = [*license_texts(), *cases.texts()]
    rows = {r["id"]: r for r in licenses.scan(cases.documents(spark, texts)).where("id is not null").collect()}
    for i, text in enumerate(texts):
        assert rows[i]["licenses"] == sorted({name for name, t in licenses.TEMPLATES if contained(text, t)}), text
    assert licenses.scan(cases.nothing(spark)).count() == 0
    assert licenses.scan(cases.documents(spark), ()).where("matches > 0").count() == 0


def test_large_catalogue_takes_passes(spark, monkeypatch):
    whole = {r["id"]: r["licenses"] for r in licenses.scan(cases.documents(spark, license_texts())).where("id is not null").collect()}
    monkeypatch.setattr(licenses, "PASS_SHINGLES", 60)
    parts = {r["id"]: r["licenses"] for r in licenses.scan(cases.documents(spark, license_texts())).where("id is not null").collect()}
    assert parts == whole


def test_bands_keep_their_promise():
    for similarity in (0.3, 0.5, 0.8):
        bands, rows = licenses.band_settings(similarity)
        assert (1 - similarity**rows) ** bands <= 1e-4


def secret_texts(rows=400):
    rng, out = random.Random(9), []
    for i in range(rows):
        words = cases.prose(i, 30).split()
        kind = i % 4
        if kind == 0:
            words.insert(9, f'token = "{rng.getrandbits(160):040x}"')
        elif kind == 1:
            words.insert(9, f"someone.{i}@mail{i % 9}.example.com")
        elif kind == 2:
            words.insert(9, f"{rng.randrange(10**15, 10**16)} and " + "wordwithoutend" * 2)
        out.append(" ".join(words))
    return out


def test_secrets_hold_out(spark):
    docs = cases.documents(spark, secret_texts())

    def half(found):
        return secret_scan.findings_from_format(found).where("id < 200")

    found, model = secret_scan.scan(docs, half)
    assert model is not None
    rows = [r for r in found.collect() if r["id"] >= 200]
    assert len(rows) == 200
    assert np.mean([r["is_secret"] == (r["id"] % 4 == 0) for r in rows]) > 0.98


def test_secrets_without_labels_and_without_rows(spark):
    found, model = secret_scan.scan(cases.documents(spark))
    assert model is None and found.where("is_secret").count() == found.count() > 0
    assert secret_scan.scan(cases.nothing(spark))[0].count() == 0


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for v, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None)))


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.net/en/x", "http://notexample.net/en/", "http://example.net.evil.com/en/", "http://a.b.example.com/de/1", "http://a.example.com/De/1", "http://net/", "http://net", "http://x.net?a=/en/", "http://x.org/fr/?utm_source=feed", "http://x.org/fr", "https://c.com/a?x=1&utm_source=feed#z", "https://c.com/12.html", "https://www.casino-win.info/", "http://x?y.net/", "://a.net/b", "http://é.net/", "http://x.net/\nen/", "x" * 5000 + "://deep.example.net/en/" + "y" * 5000]


def test_rules_of_hosts(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(None, "http://x.net/", "", ""), (4, URLS[4], "clash", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, token string")
    rules = url_filters.rule_table(spark, suite.HOST_RULES + url_filters.DEFAULT_PATTERNS)
    found = url_filters.judge(pages, rules).collect()
    assert len(found) == len(rows)
    by_id = {r["id"]: r for r in found if r["id"] is not None}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain_rule(url)
        r = by_id[i]
        assert (r["host"], r["path"]) == (host, path)
        if rule:
            assert (r["rule"], r["verdict"]) == (rule, verdict)
        else:
            assert (r["rank"] or 0) < 1_000_000
    assert by_id[URLS.index("https://www.casino-win.info/")]["verdict"] == "block"


def test_index_finds_what_trying_every_rule_finds(spark):
    rng = random.Random(6)
    vocabulary = ["ad", "shop", "win", "news", "x1", "cdn"]
    rules = tuple(url_filters.PatternRule(f"r{i}", rng.choice(["block", "allow"]), i % 5, tuple(rng.sample(vocabulary, i % 3)), "") for i in range(20))
    rules = tuple(url_filters.PatternRule(r.rule, r.action, r.rank, r.tokens, "".join(f"(?=.*\\b{t}\\b)" for t in r.tokens) + (".*" if r.tokens else ".*7$")) for r in rules)
    urls = [f"http://{rng.choice(vocabulary)}.{rng.choice(vocabulary)}.com/{rng.choice(vocabulary)}/{i % 30}" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = url_filters.rule_table(spark, rules)
    found = {r["id"]: r["rule"] for r in url_filters.judge(pages, table).collect()}
    import re

    for i, u in enumerate(urls):
        matching = [(r.rank, r.rule) for r in rules if re.search(r.pattern, u.removeprefix("http://"))]
        assert found[i] == (max(matching)[1] if matching else None)
    assert url_filters.judge(pages, table.limit(0)).where("verdict <> 'allow'").count() == 0
    assert url_filters.judge(pages.limit(0), table).count() == 0


@pytest.mark.parametrize("name", sorted(suite.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.difference(oracle.connect(sf_dir), suite.QUERIES[name](spark, sf_dir), suite.SQL[name]) is None


def plain_spans(text):
    """Every place is tried: values behind a credential's name first, then long runs apart from them."""
    import re

    named, at = [], 0
    while at < len(text):
        lead = re.search(r"(?i)(token|secret|password|passwd|key|apikey|credential|auth|bearer|pwd)s?[\"']?[ \t]*\Z", text[max(0, at - 24) : at], re.ASCII)
        if text[at] in ":=" and lead:
            rest = text[at + 1 :].lstrip(" \t")
            start = len(text) - len(rest)
            if rest[:1] in ("'", '"'):
                inside = rest[1:].split("\n")[0]
                value, start = (inside.split(rest[0])[0] if rest[0] in inside else ""), start + 1
            else:
                value = re.split(r"[\s\"']", rest)[0].rstrip(",;)]}")
            if len(value) >= 4:
                named.append((start, start + len(value)))
                at = start + len(value)
                continue
        at += 1
    runs = [m.span() for m in re.finditer(r"[A-Za-z0-9_+/=.@-]{16,}", text)]
    return sorted([r for r in runs if all(r[1] <= a or b <= r[0] for a, b in named)] + named)


SECRETS = [
    "password: hunter2", "my_password = 'p#ss w!rd$', next", "pwd=abc", "pwd=abcd;", 'api_key : "unclosed value', "key=\"\" key=''",
    "x" * 40, 'TOKEN="' + "0f" * 20 + '"', "keys == 'abcdefgh'", "secret=token=abcdefgh", "no name: value", "auth:\nnextline", "passwd:", "",
    "f(password=hunter22) and monkey: banana", '{"data": "password: hunter2"}', "a" * 30 + "=secret=" + "b" * 30,
]


@pytest.mark.parametrize("text", [*SECRETS, " | ".join(SECRETS), "\n".join(SECRETS)])
def test_candidates_equal_plain_search(text):
    assert secret_scan.spans(text) == plain_spans(text)


def test_short_values_of_credentials_are_candidates():
    found = {text[a:b] for text in SECRETS for a, b in secret_scan.spans(text)}
    assert {"hunter2", "p#ss w!rd$", "abcd", "hunter22", "banana"} <= found and "abc" not in found


def test_features_equal_plain_counts():
    rng = random.Random(3)
    transitions = np.log(np.arange(1, len(secret_scan.ALPHABET) ** 2 + 1).reshape(len(secret_scan.ALPHABET), -1) / 9e6)
    for _ in range(200):
        value = "".join(rng.choice("abXY019_=#é ") for _ in range(rng.randrange(4, 40)))
        got = dict(zip(secret_scan.PLAIN, secret_scan.describe(value, "my token = '", "' end", transitions, frozenset(["ab", "ba"]))))
        lowered = value.lower()
        place = [secret_scan.ALPHABET.find(c) if c in secret_scan.ALPHABET else len(secret_scan.ALPHABET) - 1 for c in lowered]
        steps = [transitions[a][b] for a, b in zip(place, place[1:])]
        assert got["length"] == len(value) and abs(got["transition"] - sum(steps) / len(steps)) < 1e-9
        shares = {c: value.count(c) / len(value) for c in set(value)}
        assert abs(got["entropy"] + sum(p * np.log2(p) for p in shares.values())) < 1e-9
        assert got["quoted"] == got["assigned"] == got["credential_near"] == 1 and got["mail_like"] == 0


def test_weights_of_paths_and_words():
    paths = ["src/config/prod.env"] * 6 + ["tests/data/sample.json"] * 6 + ["src/rare.txt"]
    labels = [1.0] * 6 + [0.0] * 6 + [0.0]
    known = secret_scan.weights(paths, labels, secret_scan.parts)
    assert set(known) == {"src", "config", "prod", ".env", "tests", "data", "sample", ".json"}
    assert abs(known[".env"] - np.log((7 / 8) / (1 / 9))) < 1e-12 and abs(known["tests"] - np.log((1 / 8) / (7 / 9))) < 1e-12
    assert secret_scan.mean_weight("x/unknown.bin", secret_scan.parts, known) == 0
    assert secret_scan.mean_weight("prod/tests", secret_scan.parts, known) == (known["prod"] + known["tests"]) / 2


def test_repeated_rows_repeat_under_a_large_catalogue(spark, monkeypatch):
    docs = cases.documents(spark, license_texts()[:20])
    whole = sorted(map(str, licenses.scan(docs).collect()))
    monkeypatch.setattr(licenses, "PASS_SHINGLES", 60)
    assert sorted(map(str, licenses.scan(docs).collect())) == whole and len(whole) == docs.count()


def test_variants_of_a_license_are_told_apart(spark):
    opening, binary, clause = (t for n, t in licenses.TEMPLATES if n.startswith("BSD"))
    rows = spark.createDataFrame([(0, f"{opening}:\n{binary}"), (1, f"{opening}:\n{binary}\n{clause}")], "doc_id long, text string")
    assert {r["id"]: r["licenses"] for r in licenses.scan(rows).collect()} == {0: ["BSD-2-Clause"], 1: ["BSD-2-Clause", "BSD-3-Clause"]}
