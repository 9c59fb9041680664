"""Payload rows whose expected results are known."""

_SEA = "14747,1474703,30559,SEA"
_PHX = "14107,1410702,30466,PHX"

R1 = (
    f"2019-05-14,WN,19393,WN,118,{_SEA},11292,1129202,30325,DEN,2019-05-15 03:10:00,"
    "2019-05-15 03:16:00,6.00,14.00,2019-05-15 03:30:00,2019-05-15 05:32:00,6.00,2019-05-15 05:50:00,"
    "2019-05-15 05:38:00,-12.00,0.00,,0.00,1024.00,47.45000000,-122.31166667,-25200.0,39.86166667,-104.67305556,"
    "-21600.0,arrived,2019-05-15 05:38:00"
)
R2 = (
    f"2019-05-14,WN,19393,WN,742,{_PHX},10713,1071302,30713,BOI,2019-05-14 13:05:00,"
    "2019-05-14 13:23:00,18.00,11.00,2019-05-14 13:34:00,2019-05-14 15:07:00,4.00,2019-05-14 15:05:00,"
    "2019-05-14 15:11:00,6.00,0.00,,0.00,735.00,33.43416667,-112.01166667,-25200.0,43.56444444,-116.22277778,"
    "-21600.0,arrived,2019-05-14 15:11:00"
)
R3 = (
    f"2019-05-14,WN,19393,WN,2290,{_PHX},10140,1014005,30140,ABQ,2019-05-14 13:40:00,"
    "2019-05-14 13:47:00,7.00,,,,,2019-05-14 14:55:00,,,0.00,,,328.00,33.43416667,-112.01166667,-25200.0,"
    "35.04027778,-106.60916667,-21600.0,departed,2019-05-14 13:47:00"
)
#: Cut off after the tenth field.
R4 = ",".join(R2.split(",")[:10])


def changed(row: str, position: int, value: str) -> str:
    fields = row.split(",")
    fields[position] = value
    return ",".join(fields)


CANCELLED, DIVERTED, ARR_DELAY = 23, 25, 22
