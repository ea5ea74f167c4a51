import re

from pyspark.sql import functions as F

from ticklake.llm.surrogates import HINT, PATTERNS, op2_surrogates, replace_entities, surrogate_table

SF = "/root/testdata/sf0.001"


def valid_card(x):
    d = [int(c) for c in x if c.isdigit()][::-1]
    return sum(d[::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2]) and (sum(d[::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2])) % 10 == 0


def test_types_formats_and_coreference(spark):
    rows = [
        (1, "Write to anna.b7@mail.example.com or call +1 (974) 555-3436 from 97.51.17.173.", "x"),
        (2, "anna.b7@mail.example.com again, max@mail.example.com too; card 4111 1111 1111 1111 and 4845168114407329.", "y"),
        (3, "Mrs Anna Lang met Mr. Peter Lang. Mr LANG and Frau Lang left. Госпожа Анна Иванова", None),
        (4, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188"', "x"), (5, "nothing here", "x"), (6, None, None), (7, "", "z"),
        (5, "call +1 (974) 555-3436", "x"), (None, "97.51.17.173", "n"), (8, "w " * 100_000 + "max@mail.example.com", "long"),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string, mentions string")
    got = replace_entities(docs).select("row.*", "n_entities").collect()
    text = {(r["doc_id"], r["mentions"]): r["text"] for r in got}
    assert len(got) == len(rows) and text[(6, None)] is None and text[(7, "z")] == ""
    for r in got:
        for _, old, _ in rows:
            for found in re.findall(r"[\w.]+@[\w.]+|\d+\.\d+\.\d+\.\d+|[0-9]{16}", old or ""):
                assert found not in (r["text"] or "")
    mail = r"[a-z.0-9]+@[a-z.]+"
    first = re.search(mail, text[(1, "x")]).group()
    other = re.findall(mail, text[(2, "y")])
    assert re.fullmatch(r"[a-z]{4}\.[a-z][0-9]@[a-z]{4}\.[a-z]{7}\.com", first) and other[0] == first != other[1]
    assert other[1].split("@")[1] == first.split("@")[1] and text[(8, "long")].endswith(other[1])
    phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", text[(1, "x")]).group()
    assert {r["text"] for r in got if r["doc_id"] == 5} == {"nothing here", f"call {phone}"} and phone != "+1 (974) 555-3436"
    assert text[(None, "n")] in text[(1, "x")]
    grouped = re.search(r"4\d{3} \d{4} \d{4} \d{4}", text[(2, "y")]).group()
    assert valid_card(grouped) and valid_card(re.search(r"4\d{15}", text[(2, "y")]).group())
    names = re.fullmatch(r"Mrs (\w+) (\w+) met Mr\. (\w+) (\w+)\. Mr (\w+) and Frau (\w+) left\. Госпожа (\w+) (\w+)", text[(3, None)]).groups()
    assert names[1] == names[3] == names[5] != names[4] and names[4].isupper()
    assert names[0].endswith("lla") and names[2].endswith("n") and names[6].endswith("на") and "Lang" not in text[(3, None)]
    assert replace_entities(docs.limit(0)).collect() == []


def test_collisions_are_resolved(spark):
    # a hundred two-digit texts: several of the entities collide at first
    ents = spark.createDataFrame([("secret", str(i)) for i in range(10, 25)] + [("ip", f"1.1.1.{i}") for i in range(40)], "kind string, text string")
    got = surrogate_table(ents, "k").collect()
    pairs = {(r["kind"], r["surrogate"]) for r in got}
    assert len(got) == 55 == len(pairs) and not pairs & {(r["kind"], r["text"]) for r in got}


def test_query_keeps_what_is_not_an_entity(spark):
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op2_surrogates(spark, SF).collect()
    assert len(out) == len(old)
    for r in out:
        assert (r["text"] == old[r["doc_id"]]) == (r["n_entities"] == 0) and len(r["text"].split("\n")) == len(old[r["doc_id"]].split("\n"))


def test_native_plan(spark):
    plan = replace_entities(spark.createDataFrame([(1, "a@b.co")], "doc_id int, text string")).select(F.col("row.*"))
    assert "Python" not in plan._jdf.queryExecution().toString()


def test_every_pattern_passes_the_hint(spark):
    samples = {
        "email": ["a@b.co", "_@x-y.z"], "ip": ["1.2.3.4", "97.51.17.173"], "secret": [f"{k}= abcdefghijklmnopqr" for k in ("token", "secret", "password", "api_key", "apikey")],
        "phone": ["+49 30 12 34 56 78", "+33 12 34 56 78", "+41-44-66-81-80", "+1 23 45", "(30) 123 456", "555-123-4567"],
        "card": ["12 34 56 78 12 34 56 78", "1-2-3-4-5-6-7-8-9-0-1-2-3", "4845168114407329", "4111 1111 1111 1111"],
        "name": [f"{t} {n}" for t, n in (("Mr", "Li"), ("Herr", "Li"), ("Monsieur", "Li"), ("Señor", "Li"), ("Sr.", "Li"), ("Господин", "Ив"), ("Κύριος", "Νι"), ("Mrs", "Li"),
                                         ("Ms", "Li"), ("Miss", "Li"), ("Frau", "Li"), ("Madame", "Li"), ("Mme", "Li"), ("Señora", "Li"), ("Sra", "Li"), ("Госпожа", "Ив"), ("Κυρία", "Νι"))],
    }
    assert set(samples) == set(PATTERNS)
    for kind, texts in samples.items():
        found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").rlike(PATTERNS[kind]), F.col("t").rlike(HINT)).collect()
        assert [r for r in found if not (r[1] and r[2])] == []
    alone = [(i, t, None) for i, t in enumerate(samples["phone"] + samples["card"])]
    got = replace_entities(spark.createDataFrame(alone, "doc_id int, text string, x string")).select("row.*", "n_entities").collect()
    assert all(r["n_entities"] == 1 and r["text"] != alone[r["doc_id"]][1] for r in got)


def test_ends_where_an_entity_has_no_other_form(spark):
    rows = [(1, "password: ________________"), (2, "mail _@-.- or _@x.com"), (3, "password: _______________7")]
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in replace_entities(spark.createDataFrame(rows, "doc_id int, text string")).select("row.*", "n_entities").collect()}
    assert got[1] == (rows[0][1], 0) and got[2][1] == 2 and "_@-.-" not in got[2][0] and "_@x.com" not in got[2][0]
    assert got[3][1] == 1 and got[3][0] != rows[2][1]
    # every text of a form is an entity, so that none is free
    full = [("phone", f"+1 {i:02} {j:02}") for i in range(100) for j in range(100)] + [("secret", str(i)) for i in range(10)] + [("secret", "_" * 16)]
    made = surrogate_table(spark.createDataFrame(full, "kind string, text string"), "k").collect()
    pairs = {(r["kind"], r["surrogate"]) for r in made}
    assert len(made) == len(full) == len(pairs) and not pairs & set(full)
