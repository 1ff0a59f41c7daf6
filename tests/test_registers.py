"""Registers by their specifications: landed rows of each kind, as files where the register is text."""

from datetime import date

from pyspark.sql import functions as F

from placewright.sources import register_specs, scan

TODAY = date(2026, 6, 1)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("source", "source_id", "name", "address", "lat", "lng", "state", F.col("date").cast("string")).collect())


def test_landed_tables(spark):
    insp = "license_ string, dba_name string, aka_name string, address string, zip string, inspection_date string, results string, latitude string, longitude string, inspection_id long"
    cdph = spark.createDataFrame([
        ("1", "LEGAL", "Sign", " 1 A St ", "60601-22", "2026-01-01T00:00:00.000", "Pass", "41.9", "-87.6", 1),
        ("1", "LEGAL", "", "1 A St", "60601", "2026-02-01T00:00:00.000", "Out of Business", "41.9", "-87.6", 2),
        ("2", "Two", None, "2 A St", None, "2025-01-01T00:00:00.000", "Fail", None, None, 3),
        ("2", "Two", None, "2 A St", None, "2026-03-01T00:00:00.000", "No Entry", None, None, 4),
        ("3", "Old", None, "3 A St", "60601", "2020-01-01T00:00:00.000", "Pass", "41.9", "-87.6", 5),
        ("0", "None", None, "3 A St", "60601", "2026-01-01T00:00:00.000", "Pass", "41.9", "-87.6", 6)], insp)
    dmv = spark.createDataFrame([
        ("7", "Garage", "of All", "1 Rd", "Troy", "12180-1", "NY", "07/01/2026", ([-73.6, 42.7],)),
        ("7", "Garage", "of All", "1 Rd", "Troy", "12180", "NY", "08/01/2026", ([-73.6, 42.7],)),
        ("8", "Late", None, "2 Rd", "Troy", "12180", "NY", "05/31/2026", None),
        ("9", "Undated", None, "2 Rd", "Troy", "12180", "NY", None, None),
        ("10", "Bare", "", "3 Rd", "Troy", "12180", "NY", "06/01/2026", None)],
        "facility string, facility_name string, facility_name_overflow string, facility_street string, facility_city string, facility_zip_code string, facility_state string, expiration_date string, georeference struct<coordinates: array<double>>")
    cpa = spark.createDataFrame([
        ("1", "2", "Shop", "5", "Elm", "Waco", "76701", "TX", "445110", None), ("1", "3", "Net", "5", "Elm", "Waco", "76701", "TX", "454110", None),
        ("1", "4", "Gone", "5", "Elm", "Waco", "76701", "TX", "722511", "2020-01-01"), ("1", "5", "Law", "5", "Elm", "Waco", "76701", "TX", "541110", None)],
        "tp_number string, loc_number string, loc_name string, address_number string, address_text string, loc_city string, loc_zip string, loc_state string, naics string, out_of_business_date string")
    nyc = spark.createDataFrame([
        ("5", "Bar", "1", "B WAY", "Queens", "11101", "0", "0", "2026-01-02T00:00:00"), ("5", "Bar", "1", "B WAY", "Queens", "11101", "0", "0", "2025-01-02T00:00:00"),
        ("6", "New", "2", "B WAY", "Queens", "11101", "40.7", "-73.9", "1900-01-01T00:00:00")],
        "camis string, dba string, building string, street string, boro string, zipcode string, latitude string, longitude string, inspection_date string")
    fdic = spark.createDataFrame([
        (1, "JPMorgan Chase Bank, National Association", "1 Q", "Ada", "OH", "45810", 40.7, -83.8, 11, "10/02/2026"), (2, "Web Bank", "1 Q", "Ada", "OH", "45810", 40.7, -83.8, 13, "10/02/2026")],
        "UNINUM long, NAME string, ADDRESS string, CITY string, STALP string, ZIP string, LATITUDE double, LONGITUDE double, SERVTYPE int, RUNDATE string")
    history = spark.createDataFrame([
        (721, 3, "Ada Bank", "2 Q", "Ada", "OH", "45810", 40.7, -83.8, 11, "2024-05-01T00:00:00"), (721, 4, "No Place", "2 Q", "Ada", "OH", "45810", None, None, 11, "2024-05-01T00:00:00"),
        (711, 5, "Opened", "2 Q", "Ada", "OH", "45810", 40.7, -83.8, 11, "2024-05-01T00:00:00")],
        "CHANGECODE int, UNINUM long, INSTNAME string, OFF_PADDR string, OFF_PCITY string, OFF_PSTALP string, OFF_PZIP5 string, OFF_LATITUDE double, OFF_LONGITUDE double, OFF_SERVTYPE int, EFFDATE string")
    tdlr = spark.createDataFrame([
        ("1", "Nails", "9 Oak", "FORT WORTH  TX 76102-1", "Salon Establishment", "06/01/2026"), ("2", "Cut", "9 Oak", "TULSA OK 74101", "Salon Establishment", "06/01/2027"),
        ("3", "Jo Doe", "9 Oak", "WACO TX 76701", "Operator", "06/01/2027"), ("4", "Late", "9 Oak", "WACO TX 76701", "Barber Establishment", "05/01/2026")],
        "license_number string, business_name string, business_address_line1 string, business_city_state_zip string, license_type string, license_expiration_date_mmddccyy string")
    raws = {"cdph_chicago": cdph, "dmv_ny": dmv, "cpa_tx": cpa, "dohmh_nyc": nyc, "fdic_locations": fdic, "fdic_history": history, "tdlr_tx": tdlr}
    got = rows_of(register_specs.evidence_of(raws, TODAY, {"cpa_tx": date(2026, 5, 20)}))
    assert got == sorted([
        ("cdph_chicago_oob", "1", "LEGAL", "1 A St, CHICAGO, IL 60601", 41.9, -87.6, "closed", "2026-02-01"),
        ("cdph_chicago", "2", "Two", "2 A St, CHICAGO, IL", None, None, "open", "2025-01-01"),
        ("dmv_ny", "7", "Garage of All", "1 Rd, Troy, NY 12180", 42.7, -73.6, "open", "2026-06-01"),
        ("dmv_ny", "10", "Bare", "3 Rd, Troy, NY 12180", None, None, "open", "2026-06-01"),
        ("cpa_tx", "1-2", "Shop", "5 Elm, Waco, TX 76701", None, None, "open", "2026-05-20"),
        ("dohmh_nyc", "5", "Bar", "1 B WAY, QUEENS, NY 11101", None, None, "open", "2026-01-02"),
        ("fdic_locations", "1", "Chase Bank", "1 Q, Ada, OH 45810", 40.7, -83.8, "open", "2026-10-02"),
        ("fdic_history", "3", "Ada Bank", "2 Q, Ada, OH 45810", 40.7, -83.8, "closed", "2024-05-01"),
        ("tdlr_tx", "1", "Nails", "9 Oak, FORT WORTH, TX 76102", None, None, "open", "2026-06-01")])


def test_landed_text(spark, tmp_path):
    def landed(source, files):
        folder = tmp_path / source
        folder.mkdir()
        for name, data in files.items():
            (folder / name).write_bytes(data)
        return scan.scan_register_text(spark, str(folder), register_specs.REGISTERS[source].file)

    abc = "Updated: the 28th of May 2026\nLicense Type, File Number,Lic or App,Type Status,Primary Name,Prem Addr 1,Prem City,Prem State,Prem Zip,DBA Name\n"
    abc += '20,11,LIC,ACTIVE,"Smith, Jo",1 Bay,Napa,CA,94558-1,Corner Store\n41,11,LIC,ACTIVE,"Smith, Jo",1 Bay,Napa,CA,94558-1,Corner Cafe\n20,12,APP,ACTIVE,X,1 Bay,Napa,CA,94558,\n09,13,LIC,ACTIVE,X,1 Bay,Napa,CA,94558,\n42,14,LIC,ACTIVE,Inn,2 Bay,Napa,CA,94558,\n'
    able = 'List of May\nLicense #,DBA NAME,FULL ADDRESS,CITY,STATE,ZIP,DATE EXPIRATION\nA1,Pub,1 Elm,Ada,OK,74820-1,2027-01-01 00:00\nA2,PUB,1 ELM,Ada,OK,74820,46500.0\nA3,Old,2 Elm,Ada,OK,74820,2026-05-31\nA4,Far,2 Elm,Waco,TX,76701,2027-01-01\nA5,Open,3 Elm,Ada,OK,74820,none\n'
    head = "BOARD\tCERTIFICATE #\tBUSINESS NAME\tFIRST LINE ADDRESS\tCITY\tSTATE\tFIVE DIGIT ZIP CODE\tEXPIRATION DATE\n"
    dpor = {"1202__crnt.txt": (head + '1\t5\tSalón "A"\t1 Oak\tBath\tVA\t24484\t07/01/2026\n1\t6\tLate\t1 Oak\tBath\tVA\t24484\t05/01/2026\n').encode("cp1252"), "1304__crnt.txt": (head + '1\t5\tSALÓN "a"\t1 OAK\tBath\tVA\t24484\t\n').encode("cp1252")}
    nces = "010000500870|01|Albertville School|x|600 E Alabama|Albertville|AL|35950|01|01095|Marshall|32|34.26|-86.2\nLEAID|x\n"
    line = lambda lic, name, day: ",".join(["D1", "1", "Dade", "2010", lic, name, "1 Sea", "Miami", "33101-1", "1", "1", "F", "R", "ok", day])
    dbpr = "\n".join([line("h", "n", "d"), line("S1", "Café", "07/15/2025"), line("S1", "Café New", "03/15/2026"), line("S2", "Undated", "")]) + "\n"
    raws = {"abc_ca": landed("abc_ca", {"a.csv": abc.encode()}), "able_ok": landed("able_ok", {"a.csv": able.encode()}), "dpor_va": landed("dpor_va", dpor), "nces_schools": landed("nces_schools", {"a.txt": nces.encode()}), "dbpr_fl_food": landed("dbpr_fl_food", {"1.csv": dbpr.encode("latin-1")})}
    assert rows_of(register_specs.evidence_of(raws, TODAY, {"nces_schools": date(2025, 6, 30)})) == sorted([
        ("abc_ca", "11", "Corner Store", "1 Bay, Napa, CA 94558", None, None, "open", "2026-05-28"),
        ("abc_ca", "14", "Inn", "2 Bay, Napa, CA 94558", None, None, "open", "2026-05-28"),
        ("able_ok", "A1", "Pub", "1 Elm, Ada, OK 74820", None, None, "open", "2026-06-01"),
        ("able_ok", "A5", "Open", "3 Elm, Ada, OK 74820", None, None, "open", "2026-06-01"),
        ("dpor_va", "1202-5", 'Salón "A"', "1 Oak, Bath, VA 24484", None, None, "open", "2026-06-01"),
        ("nces_schools", "010000500870", "Albertville School", "600 E Alabama, Albertville, AL 35950", 34.26, -86.2, "open", "2025-06-30"),
        ("dbpr_fl_food", "S1", "Café New", "1 Sea, MIAMI, FL 33101", None, None, "open", "2026-03-15")])
