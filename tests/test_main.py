import pytest
from log_help import raw_line, rows

from visitmill.__main__ import main

DAY = "2024-01-10"


def test_all_jobs_from_the_command_line(spark, tmp_path):
    texts = [raw_line(reqSerial=f"r{i}", channelForm="A", ip=f"10.0.0.{i}", customerId=c, eventName=e)
             for i, (c, e) in enumerate([("-1", "e_l"), ("c1", "e_l"), ("c2", "view")])]
    (tmp_path / "raw.log").write_text("\n".join(texts) + "\n")
    (tmp_path / "channel.txt").write_text("A\tapp\tios\tpaid\n")
    (tmp_path / "ip.txt").write_text("a|b|167772160|167772161|x|y|P|C|Z|o\n")
    for _ in range(2):
        main(["clean", str(tmp_path / "raw.log"), "--day", DAY, "--export", str(tmp_path / "out")])
    main(["channel", str(tmp_path / "channel.txt"), "--day", DAY])
    main(["region", str(tmp_path / "ip.txt"), "--day", DAY])
    main(["session", "--day", DAY])
    main(["metrics", "--day", DAY])
    assert spark.read.text(str(tmp_path / "out")).count() == 3
    assert rows(spark.table("visit_session").select("sessionID", "visitPageNum", "hour")) == [
        ("s1", 1, "11")]
    assert rows(spark.table("dw_user_visit_daliy_act")) == [(3, DAY)]
    found = spark.table("dw_customer_act_daliy_province")
    assert rows(found.select("province", "uv_act", "uv_new", "uv_all")) == [
        ("-1", 1, 0, 1), ("P", 1, 1, 1)]
    platform = spark.table("dw_visitor_act_daliy_platform")
    assert rows(platform.select("platform", "uv_act", "uv_new")) == [("ios", 3, 2)]


def test_a_job_is_required():
    with pytest.raises(SystemExit):
        main([])
