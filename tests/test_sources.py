"""Readers of files."""

import pytest

from signalbook import schemas
from signalbook.functions import text
from signalbook.operators.latest import not_loaded
from signalbook.plans import accounts as acc
from signalbook.plans import cohorts, fraud
from signalbook.sources import files


def write(path, body):
    path.write_text(body)
    return str(path)


def test_click_files_have_a_text_for_null(spark, tmp_path):
    folder = tmp_path / "clicks"
    folder.mkdir()
    write(folder / "part_0", "12_20180101,aaa,20180801\n\\N,bbb,20180801\n")
    write(folder / "part_1", "13,\\N,20180802\n13,ccc,20180802\n13,ccc,20180802\n")
    clicks = files.notification_clicks(spark, str(folder))
    assert clicks.count() == 5
    assert clicks.filter("user_id is null").count() == 1
    assert clicks.filter("notification_id is null").count() == 1
    members = spark.createDataFrame([("aaa", 0), ("ccc", 1), ("ddd", 1)], "user_id string, cluster int")
    rows = cohorts.click_through(members, clicks).collect()
    rates = {(r.cluster, r.notification_id): (r.clickers, r.ctr) for r in rows}
    assert rates == {(0, "12_20180101"): (1, 1.0), (1, "13"): (1, 0.5)}


def test_clickstream_stays_text(spark, tmp_path):
    body = "u1,170,s1,20180101\nu1,171,s1,20180101\n,172,s2,20180101\nu2,173,,20180101\n"
    clicks = files.clickstream(spark, write(tmp_path / "activity.csv", body))
    assert [t for _, t in clicks.dtypes] == ["string"] * 4
    assert [tuple(r) for r in cohorts.play_frequency(clicks).collect()] == [("u1", "s1", 2)]


def test_accounts_by_name_trimmed_and_well_formed(spark, tmp_path):
    body = "_unit_id,gender,created,text\n1, male ,x,  Hello @you  \n2,unknown,x,nope\n3,female,x,\n4,brand,x,###\n"
    accounts = files.accounts(spark, write(tmp_path / "a.csv", body))
    clean = {r.account_id: (r.gender, r.text1) for r in acc.cleaned(accounts).collect()}
    assert clean == {"1": ("male", "Hello  you"), "4": ("brand", "   ")}
    words = {r.account_id: r.words for r in acc.with_tokens(acc.cleaned(accounts)).collect()}
    assert words == {"1": ["hello", "", "you"], "4": []}


def test_accounts_have_the_columns_of_their_schema(spark, tmp_path):
    names = schemas.ACCOUNTS.fieldNames()
    row = ["7" if n == "_unit_id" else "male" if n == "gender" else "hi there" if n == "text" else "x" for n in names]
    whole = files.accounts(spark, write(tmp_path / "w.csv", ",".join(names) + "\n" + ",".join(row) + "\n"))
    assert [tuple(r) for r in whole.collect()] == [("7", "male", "hi there")]
    turned = files.accounts(spark, write(tmp_path / "t.csv", ",".join(names[::-1]) + "\n" + ",".join(row[::-1]) + "\n"))
    assert turned.collect() == whole.collect()
    for body in ("_unit_id,gender\n1,male\n", "_unit_id,gender,text,colour\n1,male,x,y\n"):
        with pytest.raises(ValueError, match="text|colour"):
            files.accounts(spark, write(tmp_path / "bad.csv", body))


def test_rows_of_different_loads_are_told_by_all_their_fields(spark, tmp_path):
    head = "card_id,member_id,amount,postcode,pos_id,transaction_dt,status\n"
    row = "1,2,30,00601,9,11-02-2018 00:00:00,"
    first = fraud.typed(files.classified_transactions(spark, write(tmp_path / "a.csv", head + row + "GENUINE\n")))
    second = files.classified_transactions(spark, write(tmp_path / "b.csv", head + row + "FRAUD\n" + row.replace("9,", "90,") + "FRAUD\n"))
    fresh = not_loaded(fraud.typed(second), first, "row_id").collect()
    assert [r.pos_id for r in fresh] == ["90"] and len(fresh[0].row_id) == 64


def test_zips_and_classified_transactions(spark, tmp_path):
    zips = files.zips(spark, write(tmp_path / "z.csv", "00601,18.18,-66.75,Adjuntas,PR,7\n"))
    assert tuple(zips.first()) == ("00601", 18.18, -66.75, "Adjuntas", "PR", "7")
    head = "card_id,member_id,amount,postcode,pos_id,transaction_dt,status\n"
    body = head + "1,2,30,00601,9,11-02-2018 00:00:00,GENUINE\n"
    loaded = files.classified_transactions(spark, write(tmp_path / "t.csv", body))
    row = fraud.typed(loaded).first()
    assert (row.amount, row.epoch, row.status) == (30, 1518307200, "GENUINE")
    bad = body + "1,2,12.5,00601,9,11-02-2018 00:00:00,FRAUD\n1,2,3,00601,9,garbage,FRAUD\n1,,3,4,5,6,FRAUD\n"
    rows = files.classified_transactions(spark, write(tmp_path / "bad.csv", bad))
    assert fraud.typed(rows).count() == 1
    assert [r.reason for r in fraud.typed_faults(rows).collect()] == ["BAD_AMOUNT", "BAD_DATE", "MISSING_FIELD"]
    files.compact(loaded, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).collect() == loaded.collect()


def test_song_metadata(spark, tmp_path):
    songs = files.song_metadata(spark, write(tmp_path / "m.csv", "s1,a1\ns1,a1\ns2,a2\n"))
    plays = spark.createDataFrame([("u1", "s1"), ("u1", "s1"), ("u2", "s9")], "user_id string, song_id string")
    members = spark.createDataFrame([("u1", 3), ("u2", 4)], "user_id string, cluster int")
    got = [tuple(r) for r in cohorts.cohort_artists(plays, members, songs).collect()]
    assert got == [(3, "u1", "s1", "a1")]


def test_clean_is_the_ascii_class(spark):
    strange = ["naïve café", "a_b-c", "１２", "x\ny\tz", "🙂 ok", "İstanbul", "it's 5%"]
    df = spark.createDataFrame([(s,) for s in strange], "t string")
    got = [r[0] for r in df.select(text.clean(df.t)).collect()]
    import re

    assert got == [re.sub("[^a-zA-Z0-9]", " ", s) for s in strange]
