import json

import pytest

from msgloom.config import PipelineConfig
from msgloom.sources import features as feature_files
from msgloom.sources import messages as source
from msgloom.sources import stopwords, vocabulary
from msgloom.staging import Staging, dense_index


def test_tolerant_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(
        "id,message,sign,datetime\n"
        'a,"say ""hi"", ok",s,2024-01-01\n'
        'b,"two\nlines",NA,null\n'
        "short,only\n"
        "long,1,2,3,4\n"
        "trailing,1,2,3,\n"
        "longer,1,2,3,,x\n"
        "longest,1,2,3,,,,\n"
        '"quoted, long",1,2,3,,"x,y"\n'
        "c,None,x,\n",
        encoding="utf-8",
    )
    assert source.has_header(spark, str(path))
    rows = source.read_messages_csv(spark, str(path)).orderBy("row_no").collect()
    assert [tuple(r)[:4] for r in rows] == [
        ("a", 'say "hi", ok', "s", "2024-01-01"),
        ("b", "two\nlines", None, None),
        ("short", "only", None, None),
        ("c", None, "x", None),
    ]


def test_headerless_csv_and_label(spark, tmp_path):
    bare = tmp_path / "bare.csv"
    bare.write_text("138,hello,s,2024-01-01\n139,hi,t,2024-01-02\n", encoding="utf-8")
    df = source.read_messages_csv(spark, str(bare))
    assert df.columns == ["phone_id", "message", "sign", "datetime", "row_no"] and df.count() == 2
    assert "id" in source.prepare(df, PipelineConfig()).columns
    labelled = tmp_path / "l.csv"
    labelled.write_text("id,message,sign,datetime,label\na,m,s,t,1\nb,m,s,t,\nc,m,s,t,0.0\n", encoding="utf-8")
    assert [r["label"] for r in source.read_messages_csv(spark, str(labelled)).orderBy("row_no").collect()] == [1, None, 0]


def test_stopwords(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\n of \n\nthe\n的　\n", encoding="utf-8")
    table = stopwords.read_stopwords(spark, str(path), ["more", "of"])
    assert sorted(r["word"] for r in table.collect()) == ["", "more", "of", "the", "的"]
    config = PipelineConfig(language="en", stopwords=("more",), stopword_paths={"en": str(path)})
    assert stopwords.stopword_list(spark, config) == ["", "more", "of", "the", "的"]
    assert stopwords.stopword_list(spark, PipelineConfig(language="cn", stopwords=("b", "a", "a"))) == ["a", "b"]
    assert "the" in stopwords.default_english()


def test_features_csv(spark, staging):
    rows = [("a", [0.5, 1.0], [2, 0, 0], 3.0, 1), ("b", [0.0, 2.5], [4, 5, 6], 1.0, 0)]
    df = spark.createDataFrame(rows, "id string, static_vec array<double>, sign_id_seq array<int>, hour_mean double, label int")
    feature_files.write_features_csv(df, f"{staging.path}/csv", {"static_vec": 2, "sign_id_seq": 3})
    with pytest.raises(ValueError):
        feature_files.write_features_csv(df, f"{staging.path}/other", {"static_vec": 2})
    header = spark.read.option("header", True).csv(f"{staging.path}/csv").columns
    assert header == ["id", "static_vec_0", "static_vec_1", "sign_id_seq_0", "sign_id_seq_1", "sign_id_seq_2", "hour_mean", "label"]
    back = feature_files.read_features_csv(spark, f"{staging.path}/csv").select(df.columns)
    assert sorted(back.collect()) == sorted(df.collect())
    feature_files.write_features(df, f"{staging.path}/pq")
    assert sorted(feature_files.read_features(spark, f"{staging.path}/pq").collect()) == sorted(df.collect())


def test_scores_sink(spark, staging):
    df = spark.createDataFrame([("a", 0.25, 1)], "id string, score double, label int")
    feature_files.write_scores(df, f"{staging.path}/s")
    assert spark.read.option("header", True).csv(f"{staging.path}/s").collect() == [("a", "0.25")]


def test_dense_index(spark, staging):
    df = spark.range(1000).selectExpr("cast(999 - id as string) as k").repartition(7)
    found = dense_index(df, ["k"], "n", staging, 5).orderBy("n").collect()
    assert [r["k"] for r in found] == sorted(str(i) for i in range(1000))
    assert [r["n"] for r in found] == list(range(5, 1005))
    assert dense_index(df.where("false"), ["k"], "n", staging).count() == 0


def test_staging_reads_back_and_drops(spark, tmp_path):
    area = Staging(spark, str(tmp_path))
    assert area.write(spark.range(3), "t").count() == 3
    area.drop()
    assert not list(tmp_path.iterdir())


def test_messages_need_models_or_labels(spark, staging):
    from msgloom.plans.features import preprocess

    df = spark.createDataFrame([("a", "m", "s", "2024-01-01")], "id string, message string, sign string, datetime string")
    with pytest.raises(ValueError):
        preprocess(df, PipelineConfig(), staging)


def test_vocabulary_json(spark, staging, tmp_path):
    signs = [("a", 2), ('quo"te\\', 3), ("签名", 4), ("{x: 1}", 5), ("", 6)]
    table = spark.createDataFrame(signs, "sign string, sign_id int")
    vocabulary.write_vocabulary_json(table, f"{staging.path}/signs")
    parts = [r["value"] for r in spark.read.text(f"{staging.path}/signs", wholetext=True).collect()]
    assert sorted(map(tuple, vocabulary.read_vocabulary_json(spark, f"{staging.path}/signs").collect())) == sorted(signs)
    if len(parts) == 1:
        assert json.loads(parts[0]) == dict(signs)
    indented = tmp_path / "indented.json"
    indented.write_text(json.dumps(dict(signs), indent=4, ensure_ascii=False), encoding="utf-8")
    assert sorted(map(tuple, vocabulary.read_vocabulary_json(spark, str(indented)).collect())) == sorted(signs)
    broken = tmp_path / "broken.json"
    broken.write_text('{"a": 1, "b": [2]}', encoding="utf-8")
    with pytest.raises(Exception, match="not a JSON object"):
        vocabulary.read_vocabulary_json(spark, str(broken)).collect()
