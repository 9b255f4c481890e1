import calendar as pycal
import datetime as dt

from creditmill.functions import calendar as cal


def brute(day, holidays):
    def working(d):
        return d.weekday() < 5 and d.strftime("%m-%d") not in cal.FIXED_HOLIDAYS and d not in holidays

    month = [dt.date(day.year, day.month, k) for k in range(1, pycal.monthrange(day.year, day.month)[1] + 1)]
    return sum(map(working, month)), sum(working(d) for d in month if d <= day)


def test_working_days_with_holidays(spark):
    extra = {dt.date(2026, 2, 17), dt.date(2026, 4, 3)}
    calendar = cal.working_calendar(spark, dt.date(2025, 12, 31), dt.date(2026, 12, 31),
                                    spark.createDataFrame([(d,) for d in extra], "dia date"))
    days = [dt.date(2026, 1, 1), dt.date(2026, 2, 17), dt.date(2026, 4, 21), dt.date(2026, 4, 30), dt.date(2026, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "dia date")
    found = {r.dia: (r.tdu, r.pdu) for r in cal.with_working_days(df, "dia", calendar).collect()}
    assert found == {d: brute(d, extra) for d in days}
