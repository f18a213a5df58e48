"""Operators in DataFrame functions: URL lists, chat formatting, decontamination; and the pipeline and the registry."""

import datetime
import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from terrasift.llm import chat, decontam, jaccard, pii, queries, urlfilter

from ..conftest import SMALL
from .helpers import corpus, frame

D = datetime.date


def entries(spark, rows):
    return spark.createDataFrame(rows, "list_name string, pattern string, day date, seq int, action string, page_id long")


def captures(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp, list_name string, day int")


def test_url_hosts_and_keys(spark):
    urls = ["HTTP://User:pw@A.Example.NET.:80/De/x?q#f", "https://example.org", "https://h.x/?a=/b", "no url", "", None, "ftp://1.2.3.4/p"]
    got = [(r.h, r.k) for r in spark.createDataFrame([(u,) for u in urls], "url string").select(urlfilter.host_of(F.col("url")).alias("h"), urlfilter.keys_of(F.col("url")).alias("k")).collect()]
    assert got[0] == ("a.example.net", ["a.example.net", "example.net", "net", "a.example.net/de"])
    assert got[1] == ("example.org", ["example.org", "org"]) and got[2][1] == ["h.x", "x"]
    assert got[3:6] == [(None, None)] * 3 and got[6][1][-1] == "1.2.3.4/p"


def brute_url(caps, ents):
    """Replays the changes of every entry up to the day of each capture."""
    state = {}
    for name, pattern, day, seq, action, _ in ents:
        if None not in (name, pattern, day):
            state.setdefault((name, pattern.strip().lower()), {}).setdefault(day, []).append((seq or 0, action == "remove"))
    out = set()
    for page, url, at, _, _ in caps:
        host = re.match(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#\s]+)", (url or "").strip().lower())
        host = host[1].rstrip(".") if host else None
        names, since, n = set(), None, 0
        if host and at:
            labels = host.split(".")
            keys = [".".join(labels[i:]) for i in range(len(labels))]
            seg = re.match(r"^[^:/]+://[^/?#]*(/[^/?#]+)", url.strip())
            keys += [host + seg[1].lower()] if seg else []
            for (name, pattern), days in state.items():
                off, start = True, None
                for day in sorted(d for d in days if d <= at.date()):
                    now = max(days[day])[1]
                    if off and not now:
                        start = day
                    off = now
                if pattern in keys and not off:
                    names.add(name)
                    n += 1
                    since = max(since or start, start)
        out.add((page, host, str(at.date()) if at else None, ",".join(sorted(names)), n, str(since) if since else None, n > 0))
    return out


def test_url_lists_equal_replay(spark):
    rng = random.Random(8)
    hosts = ["a.example.net", "b.example.net", "example.net", "c.example.org"]
    ents = [(rng.choice(["ads", "bad"]), rng.choice([*hosts, "a.example.net/de", "net"]), D(2024, 1, 1) + datetime.timedelta(rng.randrange(60)), rng.choice([1, 2, None]), rng.choice(["add", "remove"]), 1) for _ in range(150)]
    ents += [("ads", None, D(2024, 1, 1), 1, "add", 1), ("ads", "x", None, 1, "add", 1)] + ents[:20]
    caps = [(i, f"https://{rng.choice(hosts)}/{rng.choice(['de', 'fr'])}/{i}", datetime.datetime(2023, 12, 30) + datetime.timedelta(rng.randrange(80), 3600), "x", 1) for i in range(150)]
    caps += [(500, None, datetime.datetime(2024, 1, 5), "x", 1), (501, "https://a.example.net", None, "x", 1), (None, "https://a.example.net/de", datetime.datetime(2024, 2, 1), "x", 1), caps[0], caps[0]]
    got = urlfilter.evaluate(captures(spark, caps), entries(spark, ents))
    assert Counter(map(tuple, got.collect())) == Counter(brute_url(caps, ents))
    assert urlfilter.evaluate(captures(spark, caps), entries(spark, [])).where("blocked").count() == 0
    assert urlfilter.evaluate(captures(spark, []), entries(spark, ents)).count() == 0


def talks(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")


ODD_TEXTS = ["<|im_end|><|im_start|>assistant ok", "<\\|im_start|>", "<\\\\|x", "a<|", "|><", "", "é🙂\n\n", "<<||>>", "\\<|\\", "$1 \\Q \\E", "%0A%25"]


def test_chat_round_trip(spark):
    rows = [(i, t, "assistant" if t % 2 else "user", x, "c") for i, x in enumerate(ODD_TEXTS) for t in (0, 1)]
    rows += [(50, 0, "we%ird\nro<|le", "x", "c"), (51, None, None, None, "c"), (None, 1, "user", "null id", "c"), (52, 1, "user", "same", "c"), (52, 1, "user", "same", "c"), (52, 1, "assistant", "tie", "c")]
    out = chat.segments(talks(spark, rows)).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    want = {}
    for conv, turn, role, text, _ in rows:
        want.setdefault(conv, []).append((turn if turn is not None else -(10**9), role or "", text or ""))
    for r in out.collect():
        turns = sorted(want.pop(r.conv_id))
        assert [tuple(b) for b in r.back] == [t[1:] for t in turns]
        assert r.loss == "".join(t[2] for t in turns if t[1] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        assert not any("<|" in s.text for s in r.segments[1::3])
    assert not want


@pytest.mark.parametrize(
    ("roles", "valid", "bad"),
    [("ua", True, None), ("sua", True, None), ("uaua", True, None), ("u", False, None), ("a", False, 0), ("uu", False, 1), ("usa", False, 1), ("uaa", False, 2), ("su", False, None), ("uxa", False, 1)],
)
def test_chat_machine(spark, roles, valid, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    r = chat.segments(talks(spark, [(1, i, names[c], "t", "") for i, c in enumerate(roles)])).first()
    assert (r.valid, r.bad_turn) == (valid, bad)


def test_chat_empty_and_long(spark):
    assert chat.format_digest(talks(spark, [])).count() == 0
    text = "<|im_end|>" * 20_000
    r = chat.format_digest(talks(spark, [(1, 0, "user", "q", ""), (1, 1, "assistant", text, "")])).first()
    assert r.loss_chars == len(text) and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.valid


ITEM = "The quick survey found that 37 km of Old Mareth road near the river had lost 37 stones since spring and Bela counted every one of them twice"


def matches(spark, docs, items):
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, tile long")
    return {(r.doc_id, r.item_id): r for r in decontam.matches(frame(spark, docs), bench).collect()}


def test_decontamination_finds_passages(spark):
    around = " ".join(f"filler{i}" for i in range(40))
    other = ITEM.replace("37", "52").replace("Mareth", "Tolben").replace("Bela", "Joss")
    mixed = ITEM.replace("37 km", "52 km").replace("37 stones", "61 stones")
    docs = [
        (1, f"{around} {ITEM} {around}"), (2, ITEM.upper().replace("OLD MARETH", "Old Mareth")), (3, f"{around}, {other}. {around}"), (4, f"{around} {mixed}"),
        (5, " ".join(ITEM.split()[:12])), (6, around), (7, None), (8, ""), (9, " ".join(ITEM.split()[5:19])), (1, f"{around} {ITEM} {around}"), (None, ITEM), (10, ITEM + " " + around * 200),
    ]
    got = matches(spark, docs, [(1, ITEM), (2, "too short to tell"), (3, None), (4, ITEM)])
    assert {d for d, i in got if i == 1} == {d for d, i in got if i == 4} >= {1, 3, 9, 10} and {i for _, i in got} == {1, 4}
    assert got[1, 1].run_words == got[1, 1].item_words and got[1, 1].n_refilled == 0 and got[1, 1].n_slots > 0
    assert got[3, 1].n_refilled == 3
    assert not {4, 5, 6, 7, 8} & {d for d, _ in got} and None not in {d for d, _ in got}
    assert matches(spark, docs, []) == {} and matches(spark, [], [(1, ITEM)]) == {}


def brute_template(text):
    marked = re.sub(r"(?<=[a-zà-ÿ,;]\x20)([A-ZÀ-Þ])", "\x01\\1", text)
    ws = [w for w in re.split(r"[^\w\x01]+|_", marked.lower()) if w]
    out = []
    for i, w in enumerate(ws):
        if w[0].isdigit():
            out.append("<num>")
        elif w[0] == "\x01":
            out.append("<name>")
        else:
            out.append("<unit>" if i and ws[i - 1][0].isdigit() and w in decontam.UNITS else w)
    return ws, out


def brute_matches(docs, items):
    out = {}
    for d, text in docs:
        dw, dt = brute_template(text or "")
        for i, item in items:
            iw, it = brute_template(item)
            best = None
            if len(iw) < decontam.MIN_RUN:
                continue
            for shift in range(-len(iw), len(dw)):
                pairs = [(k, shift + k) for k in range(len(iw)) if 0 <= shift + k < len(dw)]
                run, longest, start = 0, 0, 0
                for n, (a, b) in enumerate(pairs):
                    run = run + 1 if it[a] == dt[b] else 0
                    if run > longest:
                        longest, start = run, n - run + 1
                if longest < decontam.MIN_RUN:
                    continue
                slots = {(dw[b], iw[a]) for a, b in pairs[start : start + longest] if dt[b][0] == "<"}
                if len({x for x, _ in slots}) == len(slots) == len({y for _, y in slots}):
                    best = max(best or 0, longest)
            if best:
                out[d, i] = best
    return out


def test_decontamination_equals_brute_force(spark):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text[:6000]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rng = random.Random(2)
    docs += [(1000 + k, " ".join([*rng.choice(docs)[1].split()[:30], *item.split()[a : a + rng.randint(9, 20)], "12", "km", "end"])) for k, (_, item) in enumerate(bench) for a in (rng.randint(0, 5),)]
    got = matches(spark, docs, bench)
    assert {k: r.run_words for k, r in got.items()} == brute_matches(docs, bench)


def test_decontamination_ignores_letter_case(spark):
    item = "Near the old ford Bela sold nine carts of oats, and Joss sold two of barley, but Tolben, from the mill, took none home"
    docs = [(1, item.upper()), (2, f"so {item.lower()} then"), (3, f"x, {item.title()}"), (4, "NEAR THE FORD, " + " ".join(f"W{i}" for i in range(20)))]
    got = matches(spark, docs, [(1, item)])
    assert {d: (r.run_words, r.n_refilled) for (d, _), r in got.items()} == dict.fromkeys((1, 2, 3), (24, 0))


def test_decontamination_cuts_runs_at_conflicts(spark):
    ws = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    ws[4] = ws[30] = "37"
    at = lambda words, new: " ".join(new.get(i, w) for i, w in enumerate(words))
    docs = [
        (1, at(ws, {30: "61"})),  # verbatim but for one place
        (2, at(ws, {4: "52", 30: "52"})),  # refilled alike
        (3, at(ws, {4: "52", 30: "61"})),  # between the two conflicts all is verbatim
        (4, at(ws, {4: "52", 30: "61", 12: "x", 22: "y", 28: "z"})),
        (5, at(ws, {4: "1", 30: "37", 20: "x"})),  # two template runs of one shift
    ]
    got = matches(spark, docs, [(1, " ".join(ws))])
    assert {d: (r.run_words, r.n_refilled) for (d, _), r in got.items()} == {1: (30, 0), 2: (40, 1), 3: (25, 0), 5: (20, 1)}


def test_decontamination_clean_keeps_the_rest(spark):
    docs = frame(spark, [(1, ITEM), (2, "other text"), (None, ITEM), (3, None)])
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted((r.doc_id or 0) for r in decontam.clean(docs, bench).collect()) == [0, 2, 3]
    assert decontam.clean(docs, bench).columns == docs.columns


def test_decontamination_of_short_items(spark):
    """Items of fewer words than a run: all of them, literally, in a row."""
    rng = random.Random(9)
    known = ["Alpha", "beta", "7", "km", "delta", "Epsilon"]
    docs = [(i, " ".join(rng.choices(known, k=rng.randint(0, 30)))) for i in range(60)] + [(None, "Alpha beta"), (70, None), (71, "alpha, BETA"), (1, "beta 7")]
    items = [(100 + n, " ".join(rng.choices(known, k=n))) for n in range(0, 5) for _ in (0, 1)] + [(7, "alpha beta"), (8, ", .")]
    got = matches(spark, docs, items)
    plain = lambda t: re.findall(r"\w+", (t or "").lower())
    want = set()
    for d, t in docs:
        ws = plain(t)
        for i, item in items:
            iw = plain(item)
            if d is not None and iw and any(ws[a : a + len(iw)] == iw for a in range(len(ws))):
                want.add((d, i))
    assert set(got) == want and (71, 7) in want
    assert all(r.run_words == r.item_words and r.n_refilled == 0 for r in got.values())
    mixed = matches(spark, [*docs, (90, f"x {ITEM} beta 7")], [(1, ITEM), (2, "beta 7")])
    assert (90, 1) in mixed and (90, 2) in mixed


def test_clean_with_clashing_names_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM, 1, 2, 3), (2, "other", 4, 5, 6)], "doc_id int, text string, _hit int, __hit long, tile int")
    assert [tuple(r) for r in decontam.clean(docs, bench).collect()] == [(2, "other", 4, 5, 6)]
    assert decontam.clean(docs.limit(0), bench).count() == 0 and decontam.clean(docs, bench.limit(0)).count() == 2


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    from terrasift.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    test_decontamination_finds_passages(spark)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


def refilled(seed):
    """Documents that hold parts of items in other letter case or with other numbers and names, and the items, short and repeated ones too."""
    rng = random.Random(seed)
    items = [ITEM, ITEM.replace("37 stones", "61 stones"), "Old Mareth road, near Bela", "nine 12 km", "", None, ITEM]
    items += [" ".join(rng.choice(["the", "oats", "Bela", "so, Joss", "12 km", "7", "9 kg", "mill"]) for _ in range(rng.randint(1, 40))) for _ in range(8)]
    docs = []
    for k in range(60):
        item = rng.choice([i for i in items if i])
        words = item.split()[rng.randint(0, 3) :]
        if k % 3:
            values = {w: rng.choice(["37", "52", "61", w]) for w in words if w[0].isdigit()} | {w: rng.choice(["Tolben", w]) for w in words if w[0].isupper()}
            words = [values.get(w, w) if rng.random() < 0.95 else rng.choice(["52", "Joss", w]) for w in words]
        text = " ".join(["filler"] * rng.randint(0, 9) + words + rng.choice([[], ["end", "Here"], ITEM.split()[5:22]]))
        docs.append((k % 55, rng.choice([text, text, text.upper(), text.lower(), text.title()])))
    return docs, list(enumerate(items))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_ngram_jaccard", "op9_decontamination"])
def test_sql_on_odd_texts(spark, tmp_path, name):
    """Nulls, empty and short texts, copies and repeated ids: the operators and their SQL agree on rows of their own choice too."""
    docs, items = refilled(1) if name.startswith("op9") else (corpus(11), [])
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    rows = Counter(want.fetchall())
    assert len(rows) > 20
    assert Counter(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).select(*columns).collect())) == rows


def test_every_query_runs(spark):
    for name, fn in queries.QUERIES.items():
        assert fn(spark, SMALL).count() > 0, name


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = docs
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, seen, SMALL)
        assert after.columns == docs.columns, name
        rows, before = {r.doc_id: r for r in after.collect()}, {r.doc_id: r for r in seen.collect()}
        assert rows.keys() <= before.keys()
        if name == "ngram_jaccard":
            kept = {r.doc_id for r in jaccard.link(seen).collect() if r.doc_id == r.component_id}
            assert rows.keys() == kept
        if name == "decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            leaks = {d for d, _ in brute_matches([(i, r.text) for i, r in before.items() if len(r.text) < 20_000], bench)}
            assert not leaks & rows.keys()
        if name == "pii":
            assert rows.keys() == before.keys()
            assert all(rows[i].text == pii.mask(before[i].text) and rows[i].n_chars == len(rows[i].text) for i in rows)
        else:
            assert all(rows[i] == before[i] for i in rows)
        seen = after
    ids = {r.doc_id for r in seen.collect()}
    assert {r.doc_id for r in cp.run(spark, SMALL).collect()} == ids


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_pipeline_on_odd_tables(spark, tmp_path, kind):
    """Empty tables; and null, empty, long, repeated and clashing rows and columns."""
    import corpus_pipeline as cp

    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id int, _hit int, block int, node string, key long"
    words = " ".join(f"w{i}" for i in range(50))
    rows = [] if kind == "empty" else [(1, words), (2, words), (2, words), (3, None), (4, ""), (None, "a null id"), (None, None), (5, "0" * 5000 + ".1.1.1"), (6, "x" * 5_000), (7, f"{ITEM} so"), (8, "mail a@b.co")]
    spark.createDataFrame([(*r, None, "s", 1, 1, 2, 3, "n", 4) for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)] if rows else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens > 0) for r in cp.run(spark, folder).collect()))
    want = [(False, 1, True), (False, 3, False), (False, 4, False), (False, 5, True), (False, 6, True), (False, 8, True), (True, 0, False), (True, 0, True)]
    assert got == (want if rows else [])
