"""A small hand-written flight table: two yearly files with two columns the reports do not know, blanks around a
carrier, a quoted comma and a value that does not parse."""

HEADER = (
    "FL_DATE,OP_CARRIER,FLT,ORIGIN,DEST,DEP_DELAY,ARR_DELAY,CANCELLED,CANCELLATION_CODE,X2,"
    "CARRIER_DELAY,WEATHER_DELAY,NAS_DELAY,SECURITY_DELAY,LATE_AIRCRAFT_DELAY"
)

ROWS_2017 = """\
2017-01-05,AA,1,JFK,LAX,12.0,20.0,0.0,,q,5.0,0.0,0.0,0.0,15.0
2017-01-06, AA ,2,JFK,LAX,8.0,10.0,0.0,,q,,,,,
2017-07-01,AA,3,JFK,SFO,-2.0,-5.0,0.0,,q,,,,,
2017-07-02,DL,4,ATL,LAX,30.0,30.0,0.0,,q,0.0,30.0,0.0,0.0,0.0
2017-07-03,DL,5,ATL,SFO,,,1.0,B,q,,,,,
2017-07-04,DL,6,ATL,SFO,,,1.0,,q,,,,,
2017-07-05,DL,7,ATL,SFO,0.0,0.0,0.0,,q,,,,,
2017-07-06,"D,L",8,ATL,SFO,1.0,abc,0.0,,q,,,,,
"""

ROWS_2018 = """\
2018-01-05,AA,1,JFK,LAX,16.0,40.0,0.0,,q,10.0,0.0,0.0,0.0,30.0
2018-07-02,DL,4,ATL,LAX,15.0,15.0,0.0,,q,0.0,15.0,0.0,0.0,0.0
2018-07-03,DL,5,ATL,SFO,20.0,15.0,0.0,,q,0.0,0.0,15.0,0.0,0.0
"""


def write_fixture(folder):
    (folder / "2017.csv").write_text(f"{HEADER}\n{ROWS_2017}")
    (folder / "2018.csv").write_text(f"{HEADER}\n{ROWS_2018}")
    return str(folder)
