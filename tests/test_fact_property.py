"""Property: the pre-aggregated order fact equals the naive fan-out join, always."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from builders import customer, fanned_out_fact, make_sources, order, part, svc
from widelines.operators.fact import sales_order_fact

line = st.tuples(st.integers(1, 6),                       # order id
                 st.sampled_from(["a", "b", "c", "d"]),   # line id (repeats on purpose)
                 st.one_of(st.none(), st.integers(0, 9)))  # quantity


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(line, max_size=10), services=st.lists(line, max_size=10),
       customer_of=st.lists(st.integers(1, 4), min_size=6, max_size=6))
def test_rewrite_equals_naive(spark, parts, services, customer_of):
    src = make_sources(
        spark,
        customers=[customer(c) for c in (1, 2, 3)],            # customer 4 is unknown
        orders=[order(o, customer_of[o - 1]) for o in range(1, 7)],
        parts=[part(f"p{lid}", oid, q) for oid, lid, q in parts],
        services=[svc(f"s{lid}", oid, q) for oid, lid, q in services])
    naive = fanned_out_fact(src)
    ours = sales_order_fact(src)
    assert ours.exceptAll(naive).count() == 0
    assert naive.exceptAll(ours).count() == 0
