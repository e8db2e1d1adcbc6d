"""Airline and country lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Airline code, airline, country.
AIRLINES = """
KAL|Korean Air|Republic of Korea
AAR|Asiana Airlines|Republic of Korea
JJA|Jeju Air|Republic of Korea
JNA|Jin Air|Republic of Korea
TWB|T'way Air|Republic of Korea
ABL|Air Busan|Republic of Korea
ASV|Air Seoul|Republic of Korea
ESR|Eastar Jet|Republic of Korea
APZ|Air Premia|Republic of Korea
EOK|Aero K|Republic of Korea
CCA|Air China|China
CES|China Eastern|China
CSN|China Southern|China
CXA|Xiamen Airlines|China
CSC|Sichuan Airlines|China
CSZ|Shenzhen Airlines|China
CSH|Shanghai Airlines|China
CDG|Shandong Airlines|China
CHH|Hainan Airlines|China
CQH|Spring Airlines|China
DKH|Juneyao Air|China
CAO|Air China Cargo|China
CKK|China Cargo Airlines|China
CPA|Cathay Pacific|Hong Kong
HKE|HK Express|Hong Kong
CRK|Hong Kong Airlines|Hong Kong
CAL|China Airlines|Taiwan
EVA|EVA Air|Taiwan
SJX|Starlux Airlines|Taiwan
TTW|Tigerair Taiwan|Taiwan
JAL|Japan Airlines|Japan
ANA|All Nippon Airways|Japan
APJ|Peach Aviation|Japan
JJP|Jetstar Japan|Japan
SKY|Skymark Airlines|Japan
TZP|ZIPAIR Tokyo|Japan
NCA|Nippon Cargo Airlines|Japan
JTA|Japan Transocean Air|Japan
PAL|Philippine Airlines|Philippines
CEB|Cebu Pacific|Philippines
HVN|Vietnam Airlines|Viet Nam
VJC|VietJet Air|Viet Nam
SIA|Singapore Airlines|Singapore
THA|Thai Airways|Thailand
MAS|Malaysia Airlines|Malaysia
GIA|Garuda Indonesia|Indonesia
AIC|Air India|India
MGL|MIAT Mongolian Airlines|Mongolia
UAE|Emirates|United Arab Emirates
ETD|Etihad Airways|United Arab Emirates
QTR|Qatar Airways|Qatar
THY|Turkish Airlines|Turkey
ETH|Ethiopian Airlines|Ethiopia
AFR|Air France|France
DLH|Lufthansa|Germany
BAW|British Airways|United Kingdom
KLM|KLM Royal Dutch Airlines|Kingdom of the Netherlands
FIN|Finnair|Finland
AFL|Aeroflot|Russian Federation
UAL|United Airlines|United States
AAL|American Airlines|United States
DAL|Delta Air Lines|United States
ASA|Alaska Airlines|United States
FDX|FedEx Express|United States
UPS|UPS Airlines|United States
GTI|Atlas Air|United States
ACA|Air Canada|Canada
"""

#: Country, ISO 3166-1 alpha-2 code.
COUNTRIES = """
Republic of Korea|kr
South Korea|kr
China|cn
Hong Kong|hk
Taiwan|tw
Japan|jp
Philippines|ph
Viet Nam|vn
Singapore|sg
Thailand|th
Malaysia|my
Indonesia|id
India|in
Mongolia|mn
United Arab Emirates|ae
Qatar|qa
Turkey|tr
Ethiopia|et
France|fr
Germany|de
United Kingdom|gb
Kingdom of the Netherlands|nl
Netherlands|nl
Finland|fi
Sweden|se
Russian Federation|ru
United States|us
Canada|ca
"""


def rows_of(table: str) -> list[tuple[str, ...]]:
    return [tuple(line.split("|")) for line in table.strip().splitlines()]


def airlines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows_of(AIRLINES), "code string, airline string, airline_country string")


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows_of(COUNTRIES), "country string, country_code string")


def with_airline(df: DataFrame, callsign: str = "callsign", country: str = "origin_country") -> DataFrame:
    """Add airline, country, country_source and country_code.

    The first three characters of the callsign name the airline and so its country; otherwise the registration country
    stands. Both dimensions are constants of this module (under a hundred rows), so they are broadcast.
    """
    spark = df.sparkSession
    code = F.upper(F.substring(F.trim(F.coalesce(F.col(callsign), F.lit(""))), 1, 3))
    named = df.withColumn("_code", code).join(F.broadcast(airlines(spark).withColumnRenamed("code", "_code")), "_code", "left").drop("_code")
    named = named.withColumn("country", F.coalesce("airline_country", F.nullif(F.col(country), F.lit(""))))
    named = named.withColumn("country_source", F.when(F.col("airline_country").isNotNull(), "airline").otherwise("registration")).drop("airline_country")
    return named.join(F.broadcast(countries(spark)), "country", "left")
