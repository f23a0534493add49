"""Names, aliases and codes defined by the publishers of the data.

Everything in this module is a constant that has to match the input files or the
published table layouts exactly.
"""

# --- Fixed values: grid areas (id, name, code, region) ---------------------------
AREAS = [
    ("hokkaido", "北海道電力", 1, "北海道"),
    ("tohoku", "東北電力", 2, "東北"),
    ("tepco", "東京電力", 3, "関東"),
    ("chubu", "中部電力", 4, "中部"),
    ("hokuriku", "北陸電力", 5, "北陸"),
    ("kansai", "関西電力", 6, "関西"),
    ("chugoku", "中国電力", 7, "中国"),
    ("shikoku", "四国電力", 8, "四国"),
    ("kyushu", "九州電力", 9, "九州"),
    ("okinawa", "沖縄電力", 10, "沖縄"),
]
ARCHIVE_AREA = 4
COMPACT_DATE_AREA = 9
BID_FEEDS = ["spot_bid_curves", "spot_splitting_areas"]

# --- Fixed values: canonical area-supply measures, in table order ----------------
SUPPLY_MEASURES = [
    "area_demand", "nuclear", "LNG", "coal", "oil", "other_fire", "hydro", "geothermal",
    "biomass", "solar_actual", "solar_control", "wind_actual", "wind_control",
    "pumped_storage", "battery", "interconnection", "other", "total",
]

# --- Fixed values: header spellings of area-supply files (trimmed, lower case) ---
SUPPLY_ALIASES = {
    "date": ["date"],
    "slot": ["time"],
    "area_demand": ["エリア需要", "実績(万kw)"],
    "nuclear": ["原子力"],
    "LNG": ["火力(lng)", "火力（ｌｎｇ）"],
    "coal": ["火力(石炭)", "火力（石炭）"],
    "oil": ["火力(石油)", "火力（石油）"],
    "other_fire": ["火力(その他)", "火力（その他）"],
    "hydro": ["水力"],
    "geothermal": ["地熱"],
    "biomass": ["バイオマス"],
    "solar_actual": ["太陽光発電実績", "太陽光実績"],
    "solar_control": ["太陽光出力制御量", "太陽光制御量"],
    "wind_actual": ["風力発電実績", "風力実績"],
    "wind_control": ["風力出力制御量", "風力制御量"],
    "pumped_storage": ["揚水"],
    "battery": ["蓄電池"],
    "interconnection": ["連系線"],
    "other": ["その他"],
    "total": ["合計"],
}
# The yearly archive of one area knows only the first spelling of each column.
ARCHIVE_ALIASES = {name: spellings[:1] for name, spellings in SUPPLY_ALIASES.items()}

# --- Fixed values: day-ahead price columns (cell number, header, name) -----------
PRICE_HEADER_CELL = "年月日"
PRICE_CELLS = [
    (0, "年月日", "date"),
    (1, "時刻コード", "slot"),
    (2, "売り入札量(kWh)", "sell_bid_qty_kwh"),
    (3, "買い入札量(kWh)", "buy_bid_qty_kwh"),
    (4, "約定総量(kWh)", "contract_qty_kwh"),
    (5, "システムプライス(円/kWh)", "ap0_system"),
    (6, "エリアプライス北海道(円/kWh)", "ap1_hokkaido"),
    (7, "エリアプライス東北(円/kWh)", "ap2_tohoku"),
    (8, "エリアプライス東京(円/kWh)", "ap3_tokyo"),
    (9, "エリアプライス中部(円/kWh)", "ap4_chubu"),
    (10, "エリアプライス北陸(円/kWh)", "ap5_hokuriku"),
    (11, "エリアプライス関西(円/kWh)", "ap6_kansai"),
    (12, "エリアプライス中国(円/kWh)", "ap7_chugoku"),
    (13, "エリアプライス四国(円/kWh)", "ap8_shikoku"),
    (14, "エリアプライス九州(円/kWh)", "ap9_kyushu"),
    (16, "スポット・時間前平均価格(円/kWh)", "spot_avg_price"),
    (17, "α上限値×スポット・時間前平均価格(円/kWh)", "alpha_upper_spot_avg_price"),
    (18, "α下限値×スポット・時間前平均価格(円/kWh)", "alpha_lower_spot_avg_price"),
    (19, "α速報値×スポット・時間前平均価格(円/kWh)", "alpha_flash_spot_avg_price"),
    (20, "α確報値×スポット・時間前平均価格(円/kWh)", "alpha_confirmed_spot_avg_price"),
    (22, "回避可能原価全国値(円/kWh)", "avoidable_cost_national"),
    (23, "回避可能原価北海道(円/kWh)", "avoidable_cost_hokkaido"),
    (24, "回避可能原価東北(円/kWh)", "avoidable_cost_tohoku"),
    (25, "回避可能原価東京(円/kWh)", "avoidable_cost_tokyo"),
    (26, "回避可能原価中部(円/kWh)", "avoidable_cost_chubu"),
    (27, "回避可能原価北陸(円/kWh)", "avoidable_cost_hokuriku"),
    (28, "回避可能原価関西(円/kWh)", "avoidable_cost_kansai"),
    (29, "回避可能原価中国(円/kWh)", "avoidable_cost_chugoku"),
    (30, "回避可能原価四国(円/kWh)", "avoidable_cost_shikoku"),
    (31, "回避可能原価九州(円/kWh)", "avoidable_cost_kyushu"),
    (33, "売りブロック入札総量(kWh)", "sell_block_bid_qty_kwh"),
    (34, "売りブロック約定総量(kWh)", "sell_block_contract_qty_kwh"),
    (35, "買いブロック入札総量(kWh)", "buy_block_bid_qty_kwh"),
    (36, "買いブロック約定総量(kWh)", "buy_block_contract_qty_kwh"),
    (38, "FIP参照価格（卸電力取引市場分）全国値(円/kWh)", "fip_ref_price_national"),
    (39, "FIP参照価格（卸電力取引市場分）北海道(円/kWh)", "fip_ref_price_hokkaido"),
    (40, "FIP参照価格（卸電力取引市場分）東北(円/kWh)", "fip_ref_price_tohoku"),
    (41, "FIP参照価格（卸電力取引市場分）東京(円/kWh)", "fip_ref_price_tokyo"),
    (42, "FIP参照価格（卸電力取引市場分）中部(円/kWh)", "fip_ref_price_chubu"),
    (43, "FIP参照価格（卸電力取引市場分）北陸(円/kWh)", "fip_ref_price_hokuriku"),
    (44, "FIP参照価格（卸電力取引市場分）関西(円/kWh)", "fip_ref_price_kansai"),
    (45, "FIP参照価格（卸電力取引市場分）中国(円/kWh)", "fip_ref_price_chugoku"),
    (46, "FIP参照価格（卸電力取引市場分）四国(円/kWh)", "fip_ref_price_shikoku"),
    (47, "FIP参照価格（卸電力取引市場分）九州(円/kWh)", "fip_ref_price_kyushu"),
]

# --- Fixed values: unit-generation fields and generation types -------------------
UNIT_FIELDS = {
    "htdnsCd": "plant_code",
    "areaCd": "area_code",
    "unitNm": "unit_num",
    "tgtDate": "date",
    "htdnsNm": "plant_name",
    "htdnNm": "gen_method",
    "dayElr": "total",
}
UNIT_SLOT_PREFIX = "htdnRslt"
GENERATION_TYPES = {
    "原子力": "nuclear",
    "火力（ガス）": "LNG",
    "火力（石炭）": "coal",
    "火力（石油）": "oil",
    "水力": "hydro",
    "地熱": "geothermal",
    "その他": "biomass",
    "太陽光": "solar",
    "風力": "wind",
    "揚水": "pumped_storage",
    "蓄電池": "battery",
}
GENERATION_DEFAULT = "other_fire"

# --- Fixed values: plant-operation headers ---------------------------------------
PLANT_HEADERS = {
    "発電所コード": "plant_code",
    "エリア": "area",
    "発電所名": "plant_name",
    "ユニット名": "unit_name",
    "発電方式・燃種": "plant_type",
    "対象日": "date",
}
PLANT_ENERGY_MARK = "[kWh]"
PLANT_TYPE_HINTS = ["発電方式", "燃種"]
PLANT_AREA_HINTS = ["エリア", "area"]

# --- Fixed values: weather -------------------------------------------------------
STATIONS = [
    ("47412", "札幌"), ("47575", "青森"), ("47584", "盛岡"), ("47590", "仙台"), ("47582", "秋田"),
    ("47588", "山形"), ("47595", "福島"), ("47629", "水戸"), ("47615", "宇都宮"), ("47624", "前橋"),
    ("47626", "熊谷"), ("47682", "千葉"), ("47662", "東京"), ("47670", "横浜"), ("47604", "新潟"),
    ("47607", "富山"), ("47605", "金沢"), ("47616", "福井"), ("47638", "甲府"), ("47610", "長野"),
    ("47632", "岐阜"), ("47656", "静岡"), ("47636", "名古屋"), ("47651", "津"), ("47761", "彦根"),
    ("47759", "京都"), ("47772", "大阪"), ("47770", "神戸"), ("47780", "奈良"), ("47777", "和歌山"),
    ("47746", "鳥取"), ("47741", "松江"), ("47768", "岡山"), ("47765", "広島"), ("47762", "下関"),
    ("47895", "徳島"), ("47890", "高松"), ("47887", "松山"), ("47893", "高知"), ("47807", "福岡"),
    ("47813", "佐賀"), ("47817", "長崎"), ("47819", "熊本"), ("47815", "大分"), ("47830", "宮崎"),
    ("47827", "鹿児島"), ("47936", "那覇"),
]
BEARINGS = ["北", "北北東", "北東", "東北東", "東", "東南東", "南東", "南南東",
            "南", "南南西", "南西", "西南西", "西", "西北西", "北西", "北北西"]
CALM = "静穏"
QUALITY_MARKS = ["品質", "均質", "現象なし"]
SECONDARY_MARKS = ["品質情報", "均質番号", "現象なし情報", "風向"]
UNIT_SPELLINGS = [
    ("(℃)", "_degC"), ("(時間)", "_h"), ("(m/s)", "_mps"), ("(mm)", "_mm"), ("(hPa)", "_hPa"),
    ("(MJ/㎡)", "_MJ_per_m2"), ("(MJ/�u)", "_MJ_per_m2"), ("(MJ/u)", "_MJ_per_m2"),
    ("(cm)", "_cm"), ("(%)", "_percent"), ("()", "_percent"),
]
DAILY_SPELLINGS = [("合計", "total_"), ("平均", "avg_"), ("最大", "max_"), ("最小", "min_")]
PUNCTUATION_SPELLINGS = [("/", "_per_"), (" ", "_"), ("(", ""), (")", ""), ("：", ""), ("・", "_")]
WEATHER_ALIASES = {
    "temperature": ["気温_degc_main", "avg_気温_degc", "気温_degc"],
    "sunshine_duration": ["日照時間_h_main", "total_日照時間_h", "日照時間_h"],
    "wind_speed": ["風速_mps_main", "avg_風速_mps", "風速_mps"],
    "wind_direction": ["wind_direction_intermediate"],
    "global_solar_radiation": ["全天日射量_mj_per_m2_main", "日射量_mj_per_m2_main", "全天日射量_main",
                               "日射量_main", "total_全天日射量_mj_per_m2"],
    "weather_description": ["天気_main", "天気概況_main", "天気"],
    "snowfall_depth": ["降雪_cm_main", "降雪_cm", "積雪_cm_main", "積雪_cm"],
    "precipitation": ["降水量_mm_main", "total_降水量_mm", "降水量_mm"],
}
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "--",
]
