from feedlens.llm.id_filter import id_filter, possible_members


def test_all_members_and_few_others_pass(spark):
    rows = spark.range(20_000).selectExpr("id * 7 - 50000 AS id", "'t' AS text", "1 AS extra")
    members = rows.where("id % 5 = 0").select("id")
    found = {row.id for row in possible_members(rows, "id", id_filter(members, "id")).collect()}
    wanted = {row.id for row in members.collect()}
    assert wanted <= found and len(found - wanted) < 800
    assert possible_members(rows, "id", id_filter(members.limit(0), "id")).count() == 0
    assert possible_members(rows.limit(0), "id", id_filter(members, "id")).count() == 0
