"""The command-line entry writes the twelve tables, the report and the rejects."""

import json

from docshred.__main__ import main
from tests.test_shred import HAPPY


def test_cli_writes_all_tables(spark, write_lines, tmp_path, capsys):
    docs = write_lines([HAPPY, HAPPY, "{bad"])
    (tmp_path / "o.csv").write_text("Colnames\r\nM0010\r\nM0020\r\n")
    (tmp_path / "m.csv").write_text("Colnames\r\nA0100\r\n")
    out = tmp_path / "out"
    main([docs, "--oasis", str(tmp_path / "o.csv"), "--mds", str(tmp_path / "m.csv"), "--out", str(out)])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(paths) == 14
    assert spark.read.parquet(paths["patientInfo"]).count() == 1          # duplicates removed
    assert spark.read.parquet(paths["oasis"]).columns[-2:] == ["M0010", "M0020"]
    assert spark.read.parquet(paths["_rejected"]).count() == 1
    rep = spark.read.parquet(paths["_quality"])
    assert rep.where("table = 'patientInfo'").first().actual_rows == 2     # checked before dedup
