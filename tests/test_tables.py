from noticeloom.operators.tables import DEFAULT_RULES, extract_rows


def run(spark, text):
    df = spark.createDataFrame([("object://k", text)], "source_span string, raw_text string")
    rows = extract_rows(df, DEFAULT_RULES).orderBy("table", "row_no").collect()
    return [(r.table, r.row_no, r.source_span, r.content) for r in rows]


def test_unit_conditions_fill_down_and_first_address(spark):
    rows = run(spark, """
    목록 1 서울특별시 동작구 상도동 10-2 4 호 20.1 서울특별시 동작구 흑석동 99-1 3 호 2 서울특별시 은평구 갈현동 31 2 호
    호실별 규모 및 임대조건 구분 연번 호수
    7 301 11.11 12.12 1,000 2,000 3,000 4,000
    동작구 1 501 21.50 33.25 2,000,000 150,000 4,000,000 250,000
    2 502 22.50 33.25 2,100,000 151,000 4,000,000 250,000
    은평구 1 1203 30.10 41.00 3,000,000 160,000 5,000,000 260,000
    기타사항 9 900 1.0 2.0 1,000 2,000 3,000 4,000""")
    assert [(c["district"], c["unit_no"], c["deposit_text"]) for *_, c in rows] == [
        ("동작구", "501", "2,000,000"), ("동작구", "502", "2,100,000"), ("은평구", "1203", "3,000,000")]
    assert rows[0][3]["address"] == "서울특별시 동작구 상도동 10-2"
    assert rows[0][2] == "object://k#table=unit_conditions&row=1"
    assert [r[1] for r in rows] == [1, 2, 3]


def test_vacancy(spark):
    rows = run(spark, """공급 (서울시 도봉구 해등로 12 길 7) 공실 정보 주택 호수
    들꽃 101 호 25 ㎡ 40 ㎡ 1 룸 90,000,000 210,000 협의 들꽃 1102 호 31.5 ㎡ 50.2 ㎡ 1.5 룸 95,000,000 220,500 임대 기간 2년""")
    assert [(c["housing_name"], c["unit_no"], c["exclusive_area_m2"], c["monthly_rent_text"]) for *_, c in rows] == [
        ("들꽃", "101호", "25", "210,000"), ("들꽃", "1102호", "31.5", "220,500")]
    assert rows[0][3]["address"] == "서울시 도봉구 해등로12길 7"


def test_shared_price(spark):
    rows = run(spark, """휘경마을 두레주택 안내 임대보증금 및 월임대료 보증금 1,450,000 원 보증금 2,360,000 원 보증금 3,270,000 원
    주택 203 11.92 168,300 원 113,800 원 204 12.01 임대기간 205 13.00""")
    assert [(c["unit_no"], c["exclusive_area_m2"], c["deposit_text"], c["monthly_rent_text"]) for *_, c in rows] == [
        ("203", "11.92", "1,450,000 원", "168,300 원"), ("204", "12.01", "1,450,000 원", "168,300 원")]


def test_groups_join_supply_and_rent(spark):
    rows = run(spark, """충신동 연극인 두레주택 모집 공급대상 ( 호점 ) 위치
    4 호점 종로구 충신동 1-200 2 호 101 10.1 공급 남성 102 10.2 공급
    5 호점 종로구 충신동 1-300 1 호 101 7.1 공급
    동일호점 안내 남성은 자동으로 4호점, 여성은 자동으로 5호점 (호점 내 호실은 선택 불가) 임대보증금 및 월임대료 표
    4 호점 종로구 충신동 1-200 101 10.1 1,500,000 140,000 102 10.2 1,500,000 130,500
    5 호점 종로구 충신동 1-300 101 7.1 1,500,000 80,000 ○ 임대보증금 주의 103 9.1 1,500,000 10,000""")
    got = [(c["application_unit_label"], c["supply_count"], c["gender_requirement"], c["deposit_text"],
            c["monthly_rent_text"], c["address"]) for *_, c in rows]
    assert got == [
        ("충신동 연극인 두레주택 4호점 남성", "2", "남성", "1,500,000원", "130,500~140,000원", "서울특별시 종로구 충신동 1-200"),
        ("충신동 연극인 두레주택 5호점 여성", "1", "여성", "1,500,000원", "80,000원", "서울특별시 종로구 충신동 1-300")]


def test_types_sum_and_carry_price(spark):
    rows = run(spark, """마곡 도전숙 공고 공급현황: 총 99호 공급유형별 면적 및 임대료
    공급유형 주택유형 공급호수 임대료
    18㎡형 A형 10 50,480 201,000 18.42 17.52 A1형 5 18.46 17.82 B형 7 18.19
    19㎡형 C형 (주거약자용) 3 52,800 218,000 19.60 18.25 20㎡형 D형 4 20.11 세대 내 옵션 21㎡형 E형 4 1,000 2,000 21.5""")
    got = [(c["application_unit_label"], c["supply_count"], c["deposit_text"], c["monthly_rent_text"],
            c["exclusive_area_m2"]) for *_, c in rows]
    assert got == [("마곡 도전숙 18㎡형", "22", "50,480,000원", "201,000원", "18"),
                   ("마곡 도전숙 19㎡형 주거약자", "3", "52,800,000원", "218,000원", "19")]


def test_hope_expands_gender(spark):
    rows = run(spark, """■ 공급대상 : 희망하우징 잔여세대 9호 주택명
    내발산공공기숙사 원룸형 1인실(일반) 22.3㎡ 여성2 정릉 희망하우징 원룸형 1인실 15.2㎡ 남성3 여성4
    내발산 공공기숙사 · 주소 : 서울특별시 강서구 수명로1길 9 (내발산동) 정릉 희망하우징 · 주소 : 서울특별시 성북구 정릉로 8
    주택명 임대보증금 내발산 공공기숙사 - - 110,000원 정릉 희망하우징 1,200,000원 80,900원 - 끝""")
    got = [(c["housing_name"], c["gender_requirement"], c["supply_count"], c["monthly_rent_text"], c["dormitory_fee_text"],
            c["address"]) for *_, c in rows]
    assert got == [("내발산 공공기숙사", "여성", "2", "", "110,000원", "서울특별시 강서구 수명로1길 9 (내발산동)"),
                   ("정릉 희망하우징", "남성", "3", "80,900원", "", "서울특별시 성북구 정릉로 8"),
                   ("정릉 희망하우징", "여성", "4", "80,900원", "", "서울특별시 성북구 정릉로 8")]


def test_support_program(spark):
    rows = run(spark, """전세임대형 든든주택 ■ 사업지역 : 서울특별시 전 지역 ■ 공급호수 : 1,200호 ■ 지원금액
    호당 1억원 최대 8,000만원 한도 최대 1억 5,000만원 99억원 ■ 월 임대료""")
    c = rows[0][3]
    assert (c["supply_count"], c["jeonse_deposit_text"], c["contract_deposit_text"], c["balance_payment_text"]) == (
        "1200", "보증금한도액 150,000,000원", "입주자부담금 20,000,000원", "최대지원금액 80,000,000원")
    assert c["application_unit_label"] == "전세임대형 든든주택 서울특별시 전 지역 1200호"


def test_price_table_carries(spark):
    rows = run(spark, """자치구 단지명 전용 면적 유형 모집 호수 (예비) 전세금액(천원) 난방 방식
    49 일반 3 100,000 10,000 90,000 지역난방
    송파구 푸른마을, 하늘채
    59 일반 12 4 (2) 300,000 30,000 270,000 59.9 25.1 개별난방
    주거약자 2 300,500 30,050 270,450 59.9 지역 난방
    84.5 우선공급 5 400,000 40,000 360,000 개별난방
    중구 숲속빌 74 9 350,000 35,000 315,000 개별난방""")
    got = [(c["district"], c["housing_name"], c["exclusive_area_m2"], c["application_category"], c["supply_count"],
            c["reserved_count"], c["jeonse_deposit_text"], c["heating_method"]) for *_, c in rows]
    assert got == [("송파구", "푸른마을 하늘채", "59", "일반", "12", "2", "300,000", "개별난방"),
                   ("송파구", "푸른마을 하늘채", "59", "주거약자", "2", "", "300,500", "지역난방"),
                   ("송파구", "푸른마을 하늘채", "84.5", "우선공급", "5", "", "400,000", "개별난방"),
                   ("중구", "숲속빌", "74", "", "9", "", "350,000", "개별난방")]


def test_plain_text_gives_nothing(spark):
    assert run(spark, "no tables here") == []
