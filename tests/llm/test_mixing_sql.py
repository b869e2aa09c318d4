import sql_check

from daymart.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_the_mix_is_that_of_sql(spark):
    connection = sql_check.connect(SF)
    sql_check.assert_same(QUERIES["op6_mix_sources"](spark, SF), connection, ORACLE_SQL["op6_mix_sources"])
