"""Small worked examples with their exact expected rows, in the order the text asks for."""

from datetime import date as D
from decimal import Decimal as Dec

from conftest import rows, table
from pyspark.sql import functions as F

from tallyworks.operators import graph, ordering, ranking, rates, sequences
from tallyworks.operators.ordering import dense_rank_all


def day(text):
    return D.fromisoformat(text)


def test_nth_distinct(spark):
    three = table(spark, "id int, salary int", (1, 100), (2, 200), (3, 300))
    assert rows(ranking.nth_distinct(three, "salary", 2)) == [(200,)]
    one = table(spark, "id int, salary int", (1, 100))
    assert rows(ranking.nth_distinct(one, "salary", 2)) == [(None,)]
    assert rows(ranking.nth_distinct(one.filter("false"), "salary", 2)) == [(None,)]


def test_dense_rank(spark):
    scores = spark.sql(
        "select * from values (1,3.50),(2,3.65),(3,4.00),(4,3.85),(5,4.00),(6,3.65) t(id, score)"
    )
    got = dense_rank_all(scores, "score").select("score", "rank").orderBy(F.desc("score"))
    want = ["4.00 1", "4.00 1", "3.85 2", "3.65 3", "3.65 3", "3.50 4"]
    assert [f"{s} {r}" for s, r in rows(got)] == want


def test_top_three_values_per_group(spark):
    staff = table(
        spark,
        "id int, name string, salary int, dept int",
        (1, "Joe", 85000, 1), (2, "Henry", 80000, 2), (3, "Sam", 60000, 2), (4, "Max", 90000, 1),
        (5, "Janet", 69000, 1), (6, "Randy", 85000, 1), (7, "Will", 70000, 1),
    )
    names = table(spark, "dept int, dname string", (1, "IT"), (2, "Sales"))
    got = ranking.top_n_dense(staff, "dept", "salary", 3).join(names, "dept")
    assert set(rows(got.select("dname", "name", "salary"))) == {
        ("IT", "Max", 90000), ("IT", "Joe", 85000), ("IT", "Randy", 85000), ("IT", "Will", 70000),
        ("Sales", "Henry", 80000), ("Sales", "Sam", 60000),
    }


def test_rate_with_role_filters(spark):
    done, by_driver, by_client = "completed", "cancelled_by_driver", "cancelled_by_client"
    trips = table(
        spark,
        "id int, client_id int, driver_id int, status string, request_at string",
        (1, 1, 10, done, "2013-10-01"), (2, 2, 11, by_driver, "2013-10-01"),
        (3, 3, 12, done, "2013-10-01"), (4, 4, 13, by_client, "2013-10-01"),
        (5, 1, 10, done, "2013-10-02"), (6, 2, 11, done, "2013-10-02"),
        (7, 3, 12, done, "2013-10-02"), (8, 2, 12, done, "2013-10-03"),
        (9, 3, 10, done, "2013-10-03"), (10, 4, 13, by_driver, "2013-10-03"),
    )
    users = table(
        spark, "users_id int, banned string",
        (1, "No"), (2, "Yes"), (3, "No"), (4, "No"), (10, "No"), (11, "No"), (12, "No"), (13, "No"),
    )
    got = rates.rate_with_role_filters(
        trips, users, "users_id", ["client_id", "driver_id"], F.col("banned") == "No",
        F.col("status").startswith("cancelled"), "request_at", "2013-10-01", "2013-10-03",
    )
    assert sorted((d, str(r)) for d, r in rows(got)) == [
        ("2013-10-01", "0.33"), ("2013-10-02", "0.00"), ("2013-10-03", "0.50"),
    ]


def test_fan_in(spark):
    staff = table(
        spark, "id int, name string, boss int",
        (101, "John", None), (102, "Dan", 101), (103, "James", 101), (104, "Amy", 101),
        (105, "Anne", 101), (106, "Ron", 101),
    )
    assert rows(graph.fan_in_at_least(staff.select("id", "name"), "id", staff, "boss", 5)) == [
        (101, "John", 5)
    ]


def test_consecutive_runs(spark):
    people = [10, 109, 150, 99, 145, 1455, 199, 188]
    visits = table(spark, "id int, people int", *[(i + 1, p) for i, p in enumerate(people)])
    got = sequences.consecutive_runs(visits, "id", F.col("people") >= 100, 3).orderBy("id")
    assert rows(got.select("id", "people")) == [(5, 145), (6, 1455), (7, 199), (8, 188)]
    cut = sequences.consecutive_runs(
        visits, "id", F.col("people") >= 100, 2, ranges=3, per_range=2
    )
    assert sorted(r.id for r in cut.collect()) == [2, 3, 5, 6, 7, 8]


def test_top_degree(spark):
    edges = table(spark, "a int, b int", (1, 2), (1, 3), (2, 3), (3, 4))
    assert rows(graph.top_degree(edges, "a", "b")) == [(3, 3)]
    tied = edges.unionByName(table(spark, "a int, b int", (4, 2)))
    assert sorted(rows(graph.top_degree(tied, "a", "b"))) == [(2, 3), (3, 3)]
    assert rows(graph.top_degree(tied, "a", "b", ties=False)) == [(2, 3)]


def test_degrees_make_the_edges_once(spark):
    edges = table(spark, "a int, b int", (1, 2), (1, 1), (None, 2)).filter("b > 0")
    counted = graph.degrees(edges, "a", "b")
    assert sorted(rows(counted), key=str) == [(1, 3), (2, 2), (None, 1)]
    assert "Union" not in counted._jdf.queryExecution().toString()


def test_tree_node_type(spark):
    tree = table(spark, "id int, p_id int", (1, None), (2, 1), (3, 1), (4, 2), (5, 2))
    got = dict(rows(graph.tree_node_type(tree, "id", "p_id").select("id", "type")))
    assert got == {1: "Root", 2: "Inner", 3: "Leaf", 4: "Leaf", 5: "Leaf"}
    single = table(spark, "id int, p_id int", (1, None))
    assert rows(graph.tree_node_type(single, "id", "p_id").select("id", "type")) == [(1, "Root")]


def test_swap_neighbours(spark):
    seats = table(
        spark, "id int, student string",
        (1, "Abbot"), (2, "Doris"), (3, "Emerson"), (4, "Green"), (5, "Jeames"),
    )
    got = rows(graph.swap_neighbours(seats, "id").orderBy("id"))
    assert got == [(1, "Doris"), (2, "Abbot"), (3, "Green"), (4, "Emerson"), (5, "Jeames")]


def test_covers_all(spark):
    bought = table(
        spark, "customer_id int, product_key int", (1, 5), (2, 6), (3, 5), (3, 6), (1, 6), (1, 9)
    )
    products = table(spark, "product_key int", (5,), (6,))
    got = rates.covers_all(bought, "customer_id", "product_key", products)
    assert sorted(rows(got)) == [(1,), (3,)]


def test_first_period_rows(spark):
    sales = table(
        spark, "sale_id int, product_id int, year int, quantity int, price int",
        (1, 100, 2008, 10, 5000), (2, 100, 2009, 12, 5000), (7, 200, 2011, 15, 9000),
    )
    got = ranking.first_period_rows(sales, "product_id", "year", "first_year")
    assert sorted(rows(got.select("product_id", "first_year", "quantity", "price"))) == [
        (100, 2008, 10, 5000), (200, 2011, 15, 9000),
    ]


def test_next_day_return_rate(spark):
    activity = table(
        spark, "player_id int, event_date date",
        (1, day("2016-03-01")), (1, day("2016-03-02")), (2, day("2017-06-25")),
        (3, day("2016-03-02")), (3, day("2018-07-03")),
    )
    got = rates.next_day_return_rate(activity, "player_id", "event_date")
    assert [str(r.fraction) for r in got.collect()] == ["0.33"]


def test_value_as_of(spark):
    prices = table(
        spark, "product_id int, new_price int, change_date date",
        (1, 20, day("2019-08-14")), (2, 50, day("2019-08-14")), (1, 30, day("2019-08-15")),
        (1, 35, day("2019-08-16")), (2, 65, day("2019-08-17")), (3, 20, day("2019-08-18")),
    )
    got = ranking.value_as_of(prices, "product_id", "new_price", "change_date", day("2019-08-16"), 10)
    assert sorted(rows(got)) == [(1, 35), (2, 50), (3, 10)]


def test_first_row_match_rate(spark):
    orders = table(
        spark, "id int, customer_id int, order_date string, wanted string",
        (1, 1, "2019-08-01", "2019-08-02"), (2, 2, "2019-08-02", "2019-08-02"),
        (3, 1, "2019-08-11", "2019-08-12"), (4, 3, "2019-08-24", "2019-08-24"),
        (5, 3, "2019-08-21", "2019-08-22"), (6, 2, "2019-08-11", "2019-08-13"),
        (7, 4, "2019-08-09", "2019-08-09"),
    )
    got = rates.first_row_match_rate(
        orders, "customer_id", ["order_date", "id"], F.col("order_date") == F.col("wanted")
    )
    assert [str(r.percentage) for r in got.collect()] == ["50.00"]


def test_conditional_summary(spark):
    data = table(
        spark, "country string, state string, amount int, trans_date date",
        ("US", "approved", 1000, day("2018-12-18")), ("US", "declined", 2000, day("2018-12-19")),
        ("US", "approved", 2000, day("2019-01-01")), ("DE", "approved", 2000, day("2019-01-07")),
    ).withColumn("month", F.date_format("trans_date", "yyyy-MM"))
    got = rates.conditional_summary(
        data, ["month", "country"], F.col("state") == "approved", "amount"
    )
    assert sorted(rows(got)) == [
        ("2018-12", "US", 2, 1, 3000, 1000), ("2019-01", "DE", 1, 1, 2000, 2000),
        ("2019-01", "US", 1, 1, 2000, 2000),
    ]


def test_last_within_cap(spark):
    queue = table(
        spark, "person_name string, weight int, turn int",
        ("Alice", 250, 1), ("Bob", 175, 5), ("Alex", 350, 2), ("John Cena", 400, 3),
        ("Winston", 500, 6), ("Marie", 200, 4),
    )
    got = ranking.last_within_cap(queue, ["turn"], "weight", 1000)
    assert rows(got.select("person_name")) == [("John Cena",)]
    got = ranking.last_within_cap(queue, ["turn"], "weight", 1000, ranges=3, per_range=2)
    assert rows(got.select("person_name")) == [("John Cena",)]


def test_leaders_union(spark):
    ratings = table(
        spark, "movie string, name string, rating int, created date",
        *[
            (m, u, r, day(d))
            for m, u, r, d in [
                ("Avengers", "Daniel", 3, "2020-01-12"), ("Avengers", "Monica", 4, "2020-02-11"),
                ("Avengers", "Maria", 2, "2020-02-12"), ("Avengers", "James", 1, "2020-01-01"),
                ("Frozen 2", "Daniel", 5, "2020-02-17"), ("Frozen 2", "Monica", 2, "2020-02-01"),
                ("Frozen 2", "Maria", 2, "2020-03-01"), ("Joker", "Daniel", 3, "2020-02-22"),
                ("Joker", "Monica", 4, "2020-02-25"),
            ]
        ],
    )
    busiest = ratings.groupBy("name").agg(F.count("*").alias("n"))
    best = (
        ratings.filter(F.date_format("created", "yyyy-MM") == "2020-02")
        .groupBy("movie").agg(F.avg("rating").alias("n"))
    )
    got = ranking.leaders_union([(busiest, "name", "n"), (best, "movie", "n")])
    assert rows(got) == [("Daniel",), ("Frozen 2",)]


def test_signed_sum(spark):
    trades = table(
        spark, "stock string, operation string, price int",
        ("Leaf", "Buy", 1000), ("Corona Masks", "Buy", 10), ("Leaf", "Sell", 9000),
        ("Handbags", "Buy", 30000), ("Corona Masks", "Sell", 1010), ("Corona Masks", "Buy", 1000),
        ("Corona Masks", "Sell", 500), ("Corona Masks", "Buy", 1000), ("Handbags", "Sell", 7000),
        ("Corona Masks", "Sell", 10000),
    )
    got = rates.signed_sum(trades, ["stock"], "price", F.col("operation") == "Buy")
    assert dict(rows(got)) == {"Corona Masks": 9500, "Leaf": 8000, "Handbags": -23000}


def test_total_with_zero(spark):
    users = table(
        spark, "id int, name string",
        (1, "Alice"), (2, "Bob"), (3, "Alex"), (4, "Donald"), (7, "Lee"), (13, "Jonathan"), (19, "Elvis"),
    )
    rides = table(
        spark, "user_id int, distance int",
        (1, 120), (2, 317), (3, 222), (7, 100), (13, 312), (19, 50), (7, 120), (19, 400), (7, 230),
    )
    got = rates.total_with_zero(users, rides, "id", "user_id", "distance")
    assert rows(got.orderBy(F.desc("total"), "name").select("name", "total")) == [
        ("Elvis", 450), ("Lee", 450), ("Bob", 317), ("Jonathan", 312), ("Alex", 222),
        ("Alice", 120), ("Donald", 0),
    ]


def test_conditional_rate(spark):
    users = table(spark, "user_id int", (3,), (7,), (2,), (6,))
    asks = table(
        spark, "u int, action string",
        (3, "timeout"), (3, "timeout"), (7, "confirmed"), (7, "confirmed"), (7, "confirmed"),
        (2, "confirmed"), (2, "timeout"),
    )
    got = rates.conditional_rate(users, asks, "user_id", "u", F.col("action") == "confirmed")
    assert {u: str(r) for u, r in rows(got)} == {6: "0.00", 3: "0.00", 7: "1.00", 2: "0.50"}


def test_parity_sums(spark):
    data = table(
        spark, "amount int, d string",
        (150, "2024-07-01"), (200, "2024-07-01"), (75, "2024-07-01"), (300, "2024-07-02"),
        (50, "2024-07-02"), (120, "2024-07-03"), (-3, "2024-07-04"),
    )
    assert sorted(rows(rates.parity_sums(data, ["d"], "amount"))) == [
        ("2024-07-01", 75, 350), ("2024-07-02", 0, 350), ("2024-07-03", 0, 120),
        ("2024-07-04", -3, 0),
    ]


def test_first_last_improved(spark):
    scores = table(
        spark, "student int, subject string, score int, exam_date string",
        (101, "Math", 70, "2023-01-15"), (101, "Math", 85, "2023-02-15"),
        (101, "Physics", 65, "2023-01-15"), (101, "Physics", 60, "2023-02-15"),
        (102, "Math", 80, "2023-01-15"), (102, "Math", 85, "2023-02-15"),
        (103, "Math", 90, "2023-01-15"), (104, "Physics", 75, "2023-01-15"),
        (104, "Physics", 85, "2023-02-15"),
    )
    got = sequences.first_last_improved(scores, ["student", "subject"], "exam_date", "score")
    assert sorted(rows(got)) == [
        (101, "Math", 70, 85), (102, "Math", 80, 85), (104, "Physics", 75, 85),
    ]


def test_two_phase_average(spark):
    data = table(
        spark, "u int, kind string, minutes int",
        *[(1, "free_trial", m) for m in (45, 30, 60)], *[(1, "paid", m) for m in (75, 90, 65)],
        *[(2, "free_trial", m) for m in (55, 25, 50)], (2, "cancelled", 0),
        *[(3, "free_trial", m) for m in (70, 60, 80)], *[(3, "paid", m) for m in (50, 55, 85)],
        *[(4, "free_trial", m) for m in (40, 35)], (4, "paid", 45), (4, "cancelled", 0),
        # converted without a trial: the text asks for both periods
        (5, "paid", 20),
    )
    got = rates.two_phase_average(data, "u", "kind", "minutes", "free_trial", "paid")
    assert [(u, str(a), str(b)) for u, a, b in sorted(rows(got))] == [
        (1, "45.00", "76.67"), (3, "70.00", "63.33"), (4, "37.50", "45.00"),
    ]


def test_category_pairs(spark):
    category = {101: "Electronics", 102: "Books", 103: "Books", 201: "Clothing", 202: "Clothing", 301: "Sports", 401: "Kitchen"}
    bought = [
        (1, 101), (1, 102), (1, 201), (1, 301), (2, 101), (2, 102), (2, 103), (2, 201), (3, 101),
        (3, 103), (3, 301), (3, 401), (4, 101), (4, 201), (4, 301), (4, 401), (5, 102), (5, 103),
        (5, 201), (5, 202),
    ]
    df = table(spark, "u int, category string", *[(u, category[p]) for u, p in bought])
    got = graph.category_pairs(df, "u", "category", 3)
    got = got.orderBy(F.desc("entity_count"), "category1", "category2")
    assert rows(got) == [
        ("Books", "Clothing", 3), ("Books", "Electronics", 3), ("Clothing", "Electronics", 3),
        ("Electronics", "Sports", 3),
    ]


def test_season_leader(spark):
    kind = {1: "Apparel", 2: "Apparel", 3: "Kitchen", 4: "Tech", 5: "Fitness"}
    sales = [
        (1, "2023-01-15", 5, 10), (2, "2023-01-20", 4, 15), (3, "2023-03-10", 3, 18),
        (4, "2023-04-05", 1, 20), (1, "2023-05-20", 2, 10), (2, "2023-06-12", 4, 15),
        (5, "2023-06-15", 5, 12), (3, "2023-07-24", 2, 18), (4, "2023-08-01", 5, 20),
        (5, "2023-09-03", 3, 12), (1, "2023-09-25", 6, 10), (2, "2023-11-10", 4, 15),
        (3, "2023-12-05", 6, 18), (4, "2023-12-22", 3, 20), (5, "2024-02-14", 2, 12),
    ]
    df = table(
        spark, "category string, d date, q int, price int",
        *[(kind[p], day(d), q, price) for p, d, q, price in sales],
    )
    got = ranking.season_leader(df, "d", "category", "q", F.col("q") * F.col("price"))
    assert rows(got) == [
        ("Fall", "Apparel", 10, 120), ("Spring", "Kitchen", 3, 54), ("Summer", "Tech", 5, 100),
        ("Winter", "Apparel", 9, 110),
    ]
    tie = table(spark, "category string, d date, q int, price int", ("B", day("2023-01-15"), 1, 2), ("A", day("2023-01-15"), 1, 2))
    assert rows(ranking.season_leader(tie, "d", "category", "q", F.col("price"))) == [("Winter", "A", 1, 2)]


def test_last_n_increasing(spark):
    reviews = [
        (1, "2023-01-15", 2), (1, "2023-04-15", 3), (1, "2023-07-15", 4), (1, "2023-10-15", 5),
        (2, "2023-02-01", 3), (2, "2023-05-01", 2), (2, "2023-08-01", 4), (2, "2023-11-01", 5),
        (3, "2023-03-10", 1), (3, "2023-06-10", 2), (3, "2023-09-10", 3), (3, "2023-12-10", 4),
        (4, "2023-01-20", 4), (4, "2023-04-20", 4), (4, "2023-07-20", 4),
        (5, "2023-02-15", 3), (5, "2023-05-15", 2),
        # falls first: the neighbours differ, but the last three do not rise strictly
        (6, "2023-01-01", 3), (6, "2023-02-01", 5), (6, "2023-03-01", 4),
    ]
    df = table(spark, "e int, d string, rating int", *reviews)
    got = sequences.last_n_increasing(df, "e", ["d"], "rating", 3)
    assert sorted(rows(got)) == [(1, 2), (2, 3), (3, 2)]


def test_recovery_time(spark):
    tests = [
        (1, "2023-01-15", "Positive"), (1, "2023-01-25", "Negative"), (2, "2023-02-01", "Positive"),
        (2, "2023-02-05", "Inconclusive"), (2, "2023-02-12", "Negative"), (3, "2023-01-20", "Negative"),
        (3, "2023-02-10", "Positive"), (3, "2023-02-20", "Negative"), (4, "2023-01-10", "Positive"),
        (4, "2023-01-18", "Positive"), (5, "2023-02-15", "Negative"), (5, "2023-02-20", "Negative"),
        # negative on the day of the first positive does not count, the later one does
        (6, "2023-03-01", "Positive"), (6, "2023-03-01", "Negative"), (6, "2023-03-04", "Negative"),
    ]
    df = table(spark, "p int, d date, result string", *[(p, day(d), r) for p, d, r in tests])
    got = sequences.recovery_time(df, "p", "d", "result", "Positive", "Negative")
    assert sorted(rows(got)) == [(1, 10), (2, 11), (3, 10), (6, 3)]


def test_half_year_delta(spark):
    trips = [
        (1, "2023-02-15", "120.5", "10.2"), (1, "2023-03-20", "200.0", "16.5"),
        (1, "2023-08-10", "150.0", "11.0"), (1, "2023-09-25", "180.0", "12.5"),
        (2, "2023-01-10", "100.0", "9.0"), (2, "2023-04-15", "250.0", "22.0"),
        (2, "2023-10-05", "200.0", "15.0"), (3, "2023-03-12", "80.0", "8.5"),
        (3, "2023-05-18", "90.0", "9.2"), (4, "2023-07-22", "160.0", "12.8"),
        (4, "2023-11-30", "140.0", "11.0"), (5, "2023-02-28", "110.0", "11.5"),
    ]
    df = table(
        spark, "driver int, d date, km decimal(18,2), fuel decimal(18,2)",
        *[(i, day(d), Dec(k), Dec(f)) for i, d, k, f in trips],
    )
    got = rates.half_year_delta(df, "driver", "d", "km", "fuel").orderBy(F.desc("improvement"))
    assert [(r[0], *map(str, r[1:])) for r in rows(got)] == [
        (2, "11.24", "13.33", "2.10"), (1, "11.97", "14.02", "2.05"),
    ]


def spiral(spark, *plans):
    data = []
    for who, first, members, hours in plans:
        for i, (m, h) in enumerate(zip(members, hours)):
            data.append((who, m, D.fromordinal(day(first).toordinal() + i), Dec(str(h))))
    return table(spark, "s int, subject string, d date, hours decimal(18,2)", *data)


def test_cyclic_sequence(spark):
    df = spiral(
        spark,
        (1, "2023-10-01", ["Math", "Physics", "Chemistry"] * 2, [2.5, 3, 2] * 2),
        (2, "2023-10-01", ["Algebra", "Calculus", "Statistics", "Geometry"] * 2, [4, 3.5, 2.5, 3] * 2),
        (3, "2023-10-01", ["Biology", "Chemistry"] * 2, [2, 2.5] * 2),
        # three subjects, but the second round is in another order
        (6, "2023-10-01", ["A", "B", "C", "B", "A", "C"], [1] * 6),
        # a cycle that goes on into a third round
        (7, "2023-10-01", ["A", "B", "C", "A", "B", "C", "A"], [1] * 7),
    ).unionByName(
        table(
            spark, "s int, subject string, d date, hours decimal(18,2)",
            (4, "Organic", day("2023-10-01"), Dec("3")), (4, "Physical", day("2023-10-05"), Dec("2.5")),
            *[(8, m, day(f"2023-10-{n:02}"), Dec(1)) for m, n in zip("ABCABC", (1, 2, 3, 7, 8, 9))],
        )
    )
    got = sequences.cyclic_sequence(df, "s", ["d"], "d", "subject", "hours")
    want = [(1, 3, "15.00"), (2, 4, "26.00"), (7, 3, "7.00")]
    assert [(a, b, str(c)) for a, b, c in sorted(rows(got))] == want
    cut = sequences.cyclic_sequence(df, "s", ["d"], "d", "subject", "hours", ranges=4, per_range=3)
    assert [(a, b, str(c)) for a, b, c in sorted(rows(cut))] == want


def test_extreme_pair_ratio(spark):
    data = [
        (1, "Laptop", 5, "999.99"), (1, "Mouse", 50, "19.99"), (1, "Keyboard", 25, "79.99"),
        (1, "Monitor", 15, "299.99"), (2, "Phone", 3, "699.99"), (2, "Charger", 100, "25.99"),
        (2, "Case", 75, "15.99"), (2, "Headphones", 20, "149.99"), (3, "Tablet", 2, "499.99"),
        (3, "Stylus", 80, "29.99"), (3, "Cover", 60, "39.99"), (4, "Watch", 10, "299.99"),
        (4, "Band", 25, "49.99"), (5, "Camera", 8, "599.99"), (5, "Lens", 12, "199.99"),
        # less stock by so little that the rounded ratio is 1.00
        (6, "P", 1000, "9"), (6, "Q", 1004, "1"), (6, "R", 1, "5"),
    ]
    df = table(
        spark, "s int, item string, q int, price decimal(18,2)",
        *[(s, i, q, Dec(p)) for s, i, q, p in data],
    )
    got = rates.extreme_pair_ratio(df, "s", "item", "price", "q").orderBy(F.desc("ratio"))
    assert [(s, a, b, str(r)) for s, a, b, r in rows(got)] == [
        (3, "Tablet", "Stylus", "40.00"), (2, "Phone", "Case", "25.00"),
        (1, "Laptop", "Mouse", "10.00"), (6, "P", "Q", "1.00"),
    ]


def test_loyal_entities(spark):
    buys = {
        101: [("2024-01-05", "p"), ("2024-01-15", "p"), ("2024-02-10", "p"), ("2024-02-20", "p")],
        102: [("2024-01-10", "p"), ("2024-01-12", "p"), ("2024-01-15", "r"), ("2024-01-18", "r"), ("2024-02-15", "p")],
        103: [("2024-01-01", "p"), ("2024-01-02", "p"), ("2024-01-03", "p")],
        104: [("2024-01-01", "p"), ("2024-02-01", "p"), ("2024-02-15", "p"), ("2024-03-01", "p"), ("2024-03-10", "p"), ("2024-03-15", "r")],
        # three rows, but only two purchases
        105: [("2024-01-01", "p"), ("2024-03-01", "p"), ("2024-03-02", "r")],
    }
    df = table(spark, "c int, d date, kind string", *[(c, day(d), k) for c, v in buys.items() for d, k in v])
    p, r = F.col("kind") == "p", F.col("kind") == "r"
    assert sorted(rows(rates.loyal_entities(df, "c", "d", p, r))) == [(101,), (104,)]
    assert sorted(rows(rates.loyal_entities(df, "c", "d", p, r, max_refund_share=0.5))) == [(101,), (102,), (104,)]


def test_idle_sessions(spark):
    plan = {
        ("S001", 201, "10"): [(0, "open")] + [(m, "scroll") for m in (5, 10, 15, 20, 25, 30)] + [(35, "close")],
        ("S002", 202, "11"): [(0, "open"), (2, "click"), (5, "scroll"), (8, "click"), (10, "scroll"), (15, "purchase"), (20, "close")],
        ("S003", 203, "12"): [(0, "open"), (10, "scroll"), (20, "scroll"), (25, "click"), (30, "scroll"), (40, "scroll"), (50, "scroll"), (59, "close")],
        ("S004", 204, "14"): [(0, "open"), (5, "scroll"), (8, "scroll"), (10, "click"), (12, "close")],
    }
    data = [(s, u, f"2024-03-01 {h}:{m:02}:00", k) for (s, u, h), ev in plan.items() for m, k in ev]
    df = table(spark, "s string, u int, ts string, kind string", *data)
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    kind = F.col("kind")
    got = rates.idle_sessions(df, "s", "u", "ts", kind == "scroll", kind == "click", kind == "purchase")
    assert rows(got) == [("S001", 201, 35, 6)]


def test_transition_counts(spark):
    courses = {101: "Python Basics", 102: "SQL Fundamentals", 103: "JavaScript", 104: "React Basics", 105: "Node.js", 106: "Docker", 107: "AWS Fundamentals", 108: "Data Science", 109: "Machine Learning"}
    taken = {1: [(101, 5), (102, 4), (103, 5), (104, 4), (105, 5), (106, 4)], 2: [(101, 4), (104, 5), (105, 4), (106, 5), (107, 4)], 3: [(101, 3), (102, 3), (103, 3), (104, 2), (105, 3)], 4: [(101, 5), (108, 5), (109, 5)]}
    df = table(
        spark, "u int, course string, pos int, rating int",
        *[(u, courses[c], i, r) for u, v in taken.items() for i, (c, r) in enumerate(v)],
    )
    want = [
        ("Node.js", "Docker", 2), ("React Basics", "Node.js", 2), ("Docker", "AWS Fundamentals", 1),
        ("JavaScript", "React Basics", 1), ("Python Basics", "React Basics", 1),
        ("Python Basics", "SQL Fundamentals", 1), ("SQL Fundamentals", "JavaScript", 1),
    ]
    for options in ({}, {"ranges": 3, "per_range": 3}):
        got = sequences.transition_counts(df, "u", ["pos"], "course", "rating", 5, 4, **options)
        assert rows(got.orderBy(F.desc("transition_count"), "first_item", "second_item")) == want


def test_dominant_share(spark):
    marks = {1: ["like", "like", "like", "wow", "like"], 2: ["like", "wow", "sad", "like", "wow"], 3: ["love"] * 5, 4: ["like", "like", "like", "wow", "sad"]}
    df = table(spark, "u int, item int, kind string", *[(u, i, k) for u, v in marks.items() for i, k in enumerate(v)])
    got = rates.dominant_share(df, "u", "item", "kind").orderBy(F.desc("share"), "u")
    # user 4 has exactly 60 percent: the text says "at least"
    assert [(u, k, str(s)) for u, k, s in rows(got)] == [(3, "love", "1.00"), (1, "like", "0.80"), (4, "like", "0.60")]


def test_pair_ratio_is_spread_and_counts_known_items(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "stock")
    data = [(1, 1, 9, 2), (1, 2, 5, 3), (1, 3, 1, 8), (2, 1, 9, 2), (2, 2, 1, 8), (2, None, 5, 5), (2, 2, 1, 8), (None, 1, 9, 2)]
    table(spark, "g int, i int, price int, q int", *data).write.parquet(path)
    stored = spark.read.parquet(path)
    whole = rows(rates.extreme_pair_ratio(stored, "g", "i", "price", "q"))
    assert [r[:3] for r in whole] == [(1, 1, 3)]
    monkeypatch.setattr(ordering, "TASK_BYTES", ordering._input_bytes(stored) // 9)
    dealt = rates.extreme_pair_ratio(stored, "g", "i", "price", "q")
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    assert rows(dealt) == whole
