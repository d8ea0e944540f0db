"""Secrets whole, labels of other languages, account numbers in lower case, columns of any name."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.common import keyed_rows, unkeyed
from ledgerlake.llm.mixing import mixed_documents
from ledgerlake.llm.pii import pseudonymise

CLASHES = ["pii_new", "pii_kinds", "times", "copy", "row_key", "row_hash", "row", "new", "size", "a.b"]

HIDDEN = [
    ("password: P@ssw0rd!99", "password: "), ("api_key=abc~def~ghijk, then", "api_key="), ("password: hunter2!x.", "password: "),
    ('password = "correct horse"', 'password = "'), ("secret: 'two words here' and more", "secret: '"), ("Kennwort: sommer2024", "Kennwort: "),
    ("Passwort=geheimnis", "Passwort="), ("mot de passe : Été#2024", "mot de passe : "), ("contraseña: abrete99", "contraseña: "), ("token=abcdef", "token="),
    ("pwd: kitten", "pwd: "), ("(token: aB3$x_9-zz)", "(token: "), ('password: "noend99here', 'password: "'),
]
LEFT = ["The token: kitten of the house", "a secret: nobody knows it", "token: a b c", "clave: musica y danza", "password:", 'He said "password" twice', "api and token"]


def texts(spark, given):
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    return [r for r in pseudonymise(df, "k").orderBy("doc_id").collect()]


def test_secrets_are_hidden_whole(spark):
    for (text, head), r in zip(HIDDEN, texts(spark, [t for t, _ in HIDDEN])):
        assert r.pii_kinds == ["secret"], text
        assert r.text.startswith(head) and len(r.text) == len(text)
        before, after = text[len(head) :].split(" and more")[0].split(", then")[0], r.text[len(head) :]
        same = sum(x == y for x, y in zip(before, after) if x.isascii() and x.isalnum())
        assert same <= sum(x.isascii() and x.isalnum() for x in before) / 2, (text, r.text)
        for word in before.replace('"', " ").replace("'", " ").split():
            if len(word) > 4 and word.isascii():
                assert word.strip(".),") not in after
    assert [r.text.endswith(e) for r, e in zip(texts(spark, ["api_key=abc~def~ghijk, then", "secret: 'two words here' and more"]), (", then", "' and more"))] == [True, True]


def test_prose_is_left_alone(spark):
    assert [(r.text, r.pii_kinds) for r in texts(spark, LEFT)] == [(t, []) for t in LEFT]


@pytest.mark.parametrize("account", ["de89 3704 0044 0532 0130 00", "gb82west12345698765432", "DE89 3704 0044 0532 0130 00"])
def test_account_numbers_of_either_case(spark, account):
    (r,) = texts(spark, [f"pay to {account} today"])
    new = r.text.removeprefix("pay to ").removesuffix(" today")
    assert r.pii_kinds == ["iban"] and new != account and new.islower() == account.islower()
    plain = new.replace(" ", "").upper()
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert [i for i, c in enumerate(new) if c == " "] == [i for i, c in enumerate(account) if c == " "]


def test_columns_of_any_name_stay(spark):
    rows = [(k % 30, f"call 555-12{k % 10}-4567 {'w ' * (k % 7 + 5)}", "s", k) for k in range(60)] + [(None, None, None, 60), (None, "", "s", 61)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long").select("*", *[F.concat(F.lit(c), F.col("n")).alias(c) for c in CLASHES])
    columns = [f"`{c}`" for c in CLASHES]
    hidden = pseudonymise(df, "k", kinds=None)
    assert hidden.columns == df.columns and sorted(map(str, hidden.select("n", *columns).collect())) == sorted(map(str, df.select("n", *columns).collect()))
    assert "pii_kinds" in pseudonymise(df, "k").columns
    again = unkeyed(keyed_rows(df), df.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    wanted = {r.n: str(r) for r in df.collect()}
    got = mixed.collect()
    assert got and all(str(r) == wanted[r.n] for r in got)
    assert pseudonymise(df.limit(0), "k").count() == 0


def test_pipeline_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHES])
    columns = [f"`{c}`" for c in CLASHES]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.select("doc_id", *columns).collect() for c in CLASHES)
