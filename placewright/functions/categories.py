"""Category vocabularies: coarse group, subgroup, reporting bucket, licences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Each line: a group, then categories; 'x=*' stands for every category that begins so. The first line that
# has a category decides.
GROUPS = """
services_and_business: bank
shopping: grocery_or_convenience_store food_store
food_and_drink: licensed_premises restaurant food_service
services_and_business: vehicle_repair_or_dealer
lifestyle_services: salon_or_barber_shop
food_and_drink: amenity=restaurant amenity=fast_food amenity=cafe amenity=bar amenity=pub amenity=ice_cream amenity=food_court amenity=biergarten craft=brewery craft=winery craft=distillery
health_care: amenity=pharmacy amenity=clinic amenity=doctors amenity=dentist amenity=hospital amenity=veterinary healthcare=*
education: amenity=school amenity=college amenity=university amenity=kindergarten amenity=library amenity=childcare amenity=language_school amenity=music_school amenity=driving_school
cultural_and_historic: amenity=place_of_worship historic=* tourism=artwork tourism=attraction tourism=viewpoint
travel_and_transportation: amenity=fuel amenity=car_rental amenity=car_wash amenity=bus_station amenity=ferry_terminal amenity=taxi amenity=boat_rental tourism=information
community_and_government: amenity=police amenity=fire_station amenity=townhall amenity=courthouse amenity=community_centre amenity=social_facility amenity=embassy amenity=social_centre amenity=prison amenity=public_building office=government office=diplomatic office=ngo office=association office=political_party
arts_and_entertainment: amenity=cinema amenity=theatre amenity=nightclub amenity=arts_centre amenity=events_venue amenity=casino tourism=museum tourism=gallery tourism=zoo tourism=aquarium tourism=theme_park
lodging: tourism=hotel tourism=motel tourism=hostel tourism=guest_house tourism=apartment tourism=camp_site tourism=caravan_site tourism=chalet
lifestyle_services: shop=hairdresser shop=beauty shop=massage shop=tattoo shop=laundry shop=dry_cleaning shop=cosmetics
services_and_business: shop=car_repair shop=funeral_directors shop=travel_agency shop=copyshop shop=storage_rental shop=locksmith shop=tailor amenity=bank amenity=atm amenity=post_office amenity=bureau_de_change amenity=money_transfer office=* craft=*
shopping: shop=* amenity=marketplace
sports_and_recreation: leisure=*
"""
# Fixed values, in the same form.
SUBGROUPS = """
financial_service: bank amenity=bank amenity=atm amenity=bureau_de_change amenity=money_transfer
restaurant: restaurant food_service amenity=restaurant amenity=food_court
casual_eatery: amenity=fast_food amenity=ice_cream shop=bakery
non_alcoholic_beverage_venue: amenity=cafe
alcoholic_beverage_venue: licensed_premises amenity=bar amenity=pub amenity=biergarten craft=brewery craft=winery craft=distillery
food_and_beverage_store: grocery_or_convenience_store food_store shop=supermarket shop=greengrocer shop=butcher shop=alcohol shop=wine shop=beverages shop=tobacco shop=deli shop=seafood shop=confectionery
convenience_store: shop=convenience
department_store: shop=department_store
fashion_and_apparel_store: shop=clothes shop=shoes shop=jewelry shop=fashion_accessories shop=bag
vehicle_dealer: shop=car shop=motorcycle shop=trailer shop=caravan
specialty_store: amenity=pharmacy shop=chemist shop=hardware shop=florist shop=pet shop=books shop=furniture shop=electronics shop=mobile_phone shop=gift shop=sports shop=bicycle shop=toys shop=optician shop=doityourself
personal_or_beauty_service: salon_or_barber_shop shop=hairdresser shop=beauty shop=massage shop=tattoo shop=cosmetics
laundry_service: shop=laundry shop=dry_cleaning
vehicle_service: vehicle_repair_or_dealer shop=car_repair shop=tyres amenity=car_wash
fueling_station: amenity=fuel
parking: amenity=parking
ground_transport_facility_or_service: amenity=bus_station amenity=ferry_terminal amenity=taxi amenity=car_rental
hospital: amenity=hospital
outpatient_care_facility: amenity=clinic amenity=doctors amenity=dentist
animal_or_pet_service: amenity=veterinary
place_of_learning: amenity=school amenity=college amenity=university amenity=kindergarten amenity=language_school amenity=music_school
library: amenity=library
family_service: amenity=childcare
place_of_worship: amenity=place_of_worship
historic_site: historic=*
hotel: tourism=hotel tourism=motel
museum: tourism=museum
movie_theater: amenity=cinema
performing_arts_venue: amenity=theatre amenity=arts_centre
government_office: amenity=townhall amenity=courthouse amenity=embassy office=government office=diplomatic
social_or_community_service: amenity=community_centre amenity=social_facility amenity=social_centre
shipping_or_delivery_service: amenity=post_office
park: leisure=park leisure=playground leisure=dog_park leisure=garden
sport_or_fitness_facility: leisure=fitness_centre leisure=sports_centre leisure=stadium
"""
# Fixed values. Here '*x*' stands for every category that contains x.
BUCKETS = """
bars: bar pub sports_bar cocktail_bar wine_bar dive_bar lounge brewery beer_bar irish_pub gay_bar night_club dance_club amenity=bar amenity=pub amenity=nightclub
banks and credit unions: bank credit_union bank_or_credit_union amenity=bank
gas stations: gas_station fuel_station amenity=fuel
ev chargers: *ev_charging* amenity=charging_station
grocery and convenience: grocery_store supermarket convenience_store shop=supermarket shop=convenience shop=grocery
fast food: fast_food_restaurant amenity=fast_food
restaurants and cafes: *restaurant* cafe coffee_shop amenity=cafe diner bakery sandwich_shop
museums: *museum*
parks: park leisure=park dog_park playground national_park state_park
pharmacies: pharmacy amenity=pharmacy
hotels: hotel motel tourism=hotel tourism=motel
schools: *school*
hospitals: hospital amenity=hospital
"""
#: kinds of place that cannot trade without an alcohol licence
# Kinds that sell alcohol.
NEEDS_LICENSE = "bar pub sports_bar cocktail_bar wine_bar dive_bar lounge beer_bar irish_pub gay_bar night_club dance_club hookah_bar gastropub brewery amenity=bar amenity=pub amenity=nightclub"
# The licence of each source; 'x*' stands for every source that begins so, '-x' for an exception to the line.
LICENSES = """
CDLA-Permissive-2.0: overture
Apache-2.0: fsq fsq_closed
CC0-1.0: atp wikidata_p576 biz_nola
ODbL-1.0: osm* dol_wa
CC-BY-4.0: abca_dc* bbl_dc childcare_ca mke_food mke_liquor
none-stated: abc_ca tabc_tx dbpr_fl_food abt_fl atc_mo olcc_or tdlr_tx bot_sac emd_sac lou_food abc_ky_jefferson li_phl biz_seattle biz_denver childcare_wa dor_wi_liquor isp_id_liquor lcb_wa abc_nj lcc_ne bablo_me abc_ar able_ok biz_lasvegas dchd_omaha_food mpls_food mpls_liquor llb_baltimore cph_columbus_food mdard_mi_food dph_sc_food mda_mn_food dpor_va bop_tx bop_oh phx_liquor nash_beer anc_liquor sux_food hsv_liquor det_biz det_liquor abc_nc abc_ky abc_ks plcb_pa tda_tn_food dhhs_nc_inspections foodsafety_* dca_ca_* childcare_* dbpr_fl_* -childcare_co
OPEN-NY-terms: sla_ny dmv_ny dos_ny_salons agm_ny tax_ny_tobacco ocm_ny doh_ny_food
NYC-Open-Data-terms: dohmh_nyc dcwp_nyc
Chicago-Data-Portal-terms: cdph_chicago* bacp_chicago*
PDDL-1.0: isd_boston_food isd_boston_inspection lb_boston childcare_co
etalab-2.0: sirene
"""
OTHER_LICENSE = "US-public-domain"


def rules(text: str) -> list[tuple[str, list[str]]]:
    lines = [x.partition(": ") for x in text.strip().splitlines()]
    return [(name, rest.split()) for name, _, rest in lines]


def _test(c: Column, patterns: list[str]) -> Column:
    exact = [p for p in patterns if "*" not in p and p[0] != "-"]
    out = c.isin(*exact) if exact else F.lit(False)
    for p in patterns:
        if p.startswith("*"):
            out = out | c.contains(p.strip("*"))
        elif p.endswith("*"):
            out = out | c.startswith(p[:-1])
    if left := [p[1:] for p in patterns if p[0] == "-"]:
        out = out & ~c.isin(*left)
    return out


def classify(c: Column, text: str, otherwise: str | None = None) -> Column:
    out = None
    for name, patterns in rules(text):
        test = _test(c, patterns)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out if otherwise is None else out.otherwise(otherwise)


def group_of(c: Column) -> Column:
    return classify(c, GROUPS)


def subgroup_of(c: Column) -> Column:
    return classify(c, SUBGROUPS)


def bucket(c: Column) -> Column:
    return classify(c, BUCKETS, "everything else")


def license_of(c: Column) -> Column:
    return classify(c, LICENSES, OTHER_LICENSE)


def needs_alcohol_license(c: Column) -> Column:
    return c.isin(*NEEDS_LICENSE.split())
