from checks import tables as T


def test_lines_are_ordered_behind_the_joins(spark):
    """The struct repeats a line's numbers, so it must not be part of what the joins shuffle."""
    lines = T.order_lines(spark, "/root/testdata/sf0.001", T.DEMAND)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(" in plan.partition("Join")[0] and "struct(" not in plan.partition("Join")[2]
    first = lines.orderBy("line_order").first()
    assert first.order_id == first.line_order.l_orderkey and first.quantity == first.line_order.l_quantity


def test_lines_are_the_same_wherever_orders_are_joined(spark):
    first, last = (T.order_lines(spark, "/root/testdata/sf0.001", T.DEMAND, by_order=by_order) for by_order in (False, True))
    assert first.columns == last.columns and first.count() == last.count()
    assert first.exceptAll(last).isEmpty()
