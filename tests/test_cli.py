import pytest

from alertflow.__main__ import main

CSV = 'id,keyword,location,text\n1,,,"Flood in Houston"\n2,,,A day at the park\n3,,,\n4,k,l,Fire in Texas\n'


def test_commands_from_feed_to_report(spark, tmp_path, capsys):
    (tmp_path / "feed.csv").write_text(CSV)
    for name, listed in {"lexicon": "flood\nfire\n", "places": "houston\ntexas\n", "types": "Flood\nfire\n"}.items():
        (tmp_path / name).write_text(listed)
    at = lambda name: str(tmp_path / name)
    main(["send", "--csv", at("feed.csv"), "--files", at("topic")])
    main(["parse", "--files", at("topic"), "--out", at("parsed"), "--checkpoint", at("c/parse"), "--once"])
    assert sorted(r.id for r in spark.read.json(at("parsed")).collect()) == ["1", "2", "4"]

    # One hit leaves the default word-list score undecided, below the positive class.
    find = ["alerts", "--files", at("topic"), "--lexicon", at("lexicon"), "--places", at("places"), "--types",
            at("types"), "--out", at("alerts"), "--store", at("store"), "--checkpoint", at("c/alerts"), "--once"]
    (tmp_path / "more.csv").write_text("id,keyword,location,text\n5,,,flood fire flood in Texas\n")
    main(["send", "--csv", at("more.csv"), "--files", at("topic")])
    main(find)
    assert [(r.id, r.location, r.disaster) for r in spark.read.json(at("alerts")).collect()] == [("5", "texas", "flood")]
    main(find)
    assert spark.read.parquet(at("store")).select("tweet_id").collect() == [("5",)]
    capsys.readouterr()
    main(["latest", "--store", at("store"), "--rows", "3"])
    assert "texas" in capsys.readouterr().out


def test_missing_arguments():
    with pytest.raises(SystemExit, match="--servers and --topic"):
        main(["send", "--csv", "x"])
    with pytest.raises(SystemExit):
        main(["nothing"])
