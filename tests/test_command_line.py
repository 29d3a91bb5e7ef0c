import json

import pytest

from fieldtally.__main__ import count, main, parser
from fieldtally.streaming.sinks import RunFailed


def test_from_pages_to_merged_counts(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    records = [{"kingdom": "Animalia", "scientificName": f"s{n % 3}"} for n in range(8)]
    (pages / "a.json").write_text(json.dumps({"results": records}) + "\n")
    folder = {name: str(tmp_path / name) for name in ("messages", "results", "c1", "c2", "c3")}
    files = ["--format", "parquet", "--messages", folder["messages"], "--every", "0 seconds"]
    source = ["gbif", "--pages", str(pages), "--checkpoint", folder["c1"], "--seconds", "8"]
    main(["produce", *source, *files])
    assert spark.read.parquet(folder["messages"]).count() == 8
    target = ["gbif", "--results", folder["results"], "--checkpoint", folder["c2"], "--seconds", "8"]
    main(["live", *target, *files, "--state-store", "rocksdb", "--state-partitions", "3"])
    state = tmp_path / "c2" / "state" / "0"
    assert sorted(p.name for p in state.iterdir() if p.name.isdigit()) == ["0", "1", "2"]
    assert any(state.rglob("*.changelog"))
    main(["report", "gbif", "--checkpoint", folder["c3"], "--seconds", "1", *files])
    expected = {
        "kingdom": {"kingdom": "Animalia", "count": 8},
        "species": {"species": 3},
        "source": {"source": "http://GBIF.org", "count": 8},
    }
    for by, row in expected.items():
        arguments = ["count", by, "--format", "parquet", "--results", folder["results"]]
        main(arguments)
        assert [r.asDict() for r in count(spark, parser().parse_args(arguments)).collect()] == [row]


def test_a_source_is_added_and_followed(spark, tmp_path):
    folder = {name: str(tmp_path / name) for name in ("pages", "messages", "results", "c", "followed")}
    (tmp_path / "pages").mkdir()
    (tmp_path / "messages").mkdir()
    records = [{"id": str(n), "kingdom": f"Kingdom {n}", "scientificName": "s"} for n in range(30)]
    (tmp_path / "pages" / "a.json").write_text(json.dumps({"results": records}) + "\n")
    main([
        "add", "https://obis.org", "--pages", folder["pages"], "--format", "parquet", "--messages", folder["messages"],
        "--results", folder["results"], "--checkpoint", folder["c"], "--every", "0 seconds", "--seconds", "15",
    ])
    files = ["--format", "parquet", "--results", folder["results"], "--sources", "obis"]
    for more in (["--follow", folder["followed"]], ["--follow", folder["followed"]], ["--parts"], []):
        counted = count(spark, parser().parse_args(["count", "source", *files, *more])).collect()
        assert [r.asDict() for r in counted] == [{"source": "http://OBIS.org", "count": 30}]
    kingdoms = count(spark, parser().parse_args(["count", "kingdom", *files])).collect()
    assert len(kingdoms) == 30


def test_an_added_source_that_fails_is_reported(spark, tmp_path):
    for name in ("pages", "messages"):
        (tmp_path / name).mkdir()
    (tmp_path / "pages" / "a.json").write_text('{"error":"rate limit"}\n')
    with pytest.raises(RunFailed, match="gbif_producer: .*rate limit"):
        main([
            "add", "https://gbif.org", "--pages", str(tmp_path / "pages"), "--format", "parquet",
            "--messages", str(tmp_path / "messages"), "--results", str(tmp_path / "results"),
            "--checkpoint", str(tmp_path / "c"), "--every", "0 seconds", "--seconds", "60",
        ])


def test_unknown_choices():
    for arguments in (["count", "phylum"], ["report", "ebird", "--checkpoint", "/c"], []):
        with pytest.raises(SystemExit):
            parser().parse_args(arguments)
