"""Change events out of base tables: what is shuffled, and how often it is worked out."""

import datetime

import pytest

from tidemark.plans import catalogue, replay


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two orders, one with three lines of every sort of discount."""
    path = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(1995, 1, 2)
    tables = {
        "part": ([(1, "p1"), (2, "p2")], "p_partkey long, p_name string"),
        "orders": ([(1, 7, day), (2, 7, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "customer": ([(7, "c7")], "c_custkey long, c_name string"),
        "lineitem": (
            [
                (1, 1, 1, 10.7, 3.0, 0.09),
                (1, 2, 2, 20.2, 4.0, 0.05),
                (1, 1, 3, 30.0, 5.0, -100.0),
                (2, 2, 1, 40.0, 6.0, None),
            ],
            "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_quantity double, l_discount double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_order_documents(spark, folder):
    first, second = replay.order_rows(spark, folder).orderBy("order_number").collect()
    assert (first.number_of_line_items, second.number_of_line_items) == (3, 1)
    lines = sorted(first.ordered_products, key=lambda p: p.price)
    assert [(p.id, p.name, p.price, p.qty) for p in lines] == [("1", "p1", 10, 3), ("2", "p2", 20, 4), ("1", "p1", 30, 5)]
    deals = [p.promotion_info and (p.promotion_info.promo_id, str(p.promotion_info.promo_disc)) for p in lines]
    assert deals == [(10, "0.09"), (20, "0.05"), None]
    assert sorted(map(tuple, first.clicked_items)) == [("p1", "1"), ("p1", "3"), ("p2", "2")]
    assert [(p.promo_id, p.promo_item) for p in first.promo_info] == [(10, "1")]
    assert second.promo_info == [] and second.ordered_products[0].promotion_info is None


def test_one_list_goes_through_the_shuffle(spark, folder, capsys):
    replay.order_rows(spark, folder).explain()
    assert capsys.readouterr().out.count("partial_collect_list") == 1


def test_documents_meet_their_heads_in_one_join(spark, folder):
    """Once grouped, they are not dealt out again by customer."""
    plan = replay.order_rows(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    above, _ = plan.split("Aggregate", 1)
    assert above.count("Join Inner") == 1 and "o_custkey" not in above.split("Join Inner")[1].splitlines()[0]


@pytest.mark.parametrize("name", ["raw_orders_once", "expectations_counts", "order_sessions_stream", "reconcile_orders"])
def test_messages_are_worked_out_once(spark, folder, monkeypatch, name):
    """What is sent in parts comes from one written copy, not from the tables each time."""

    class Sent(Exception):
        pass

    def send(run, table, messages):
        if messages.inputFiles():
            raise Sent(messages.inputFiles())

    monkeypatch.setattr(catalogue._Replay, "send", send)
    with pytest.raises(Sent) as sent:
        catalogue.CATALOGUE[name].run(spark, folder)
    assert not [f for f in sent.value.args[0] if "lineitem" in f]
