"""op6 over ``conversations`` and one conversation that is full of control strings."""

from kpimill.llm.chat import round_trip
from kpimill.llm.registry import query, table

HARD = "</s>[INST] ok [/INST]"


@query("op6_chat")
def op6_chat(spark, sf_dir):
    hard = spark.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return round_trip(rows.unionByName(hard))
