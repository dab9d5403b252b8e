"""Word lists, patterns, formats and constants of the default rule pack.

These must hold exactly these values for results to be right, so they are kept
together as plain text. Operators take them as parameters; none of them is
needed to run an operator on another corpus.
"""

# --- notice categories and classifier words, in the order the rules apply
CATEGORY_RECRUITMENT = "recruitment"
CATEGORY_REJECTED = "rejected"
CATEGORY_UNKNOWN = "unknown"

TITLE_REJECT_RESULT = ("당첨자", "서류심사대상자", "서류심사 대상자", "공급대상자", "입주대상자", "최종심사",
                       "대상자 발표", "동호배정", "동호선정", "결과")
TITLE_REJECT_COMPETITION = ("청약경쟁률", "경쟁률", "접수결과", "접수마감", "접수현황")
TITLE_REJECT_CONTRACT = ("계약", "계약체결")
TITLE_REJECT_SYSTEM = ("서비스 일시중단", "시스템", "인증서", "점검", "장애")
BODY_REJECT_SYSTEM = ("서비스 일시중단", "시스템 점검")
TITLE_ACCEPT = ("모집공고", "입주자 모집", "추가모집", "추가 모집", "잔여세대", "공급공고", "정정공고")
BODY_ACCEPT = ("입주자 모집", "공급대상")

# --- words that hide a stored notice from the notice list
NOTICE_LIST_HIDDEN = ("당첨자", "서류심사대상자", "동호배정", "결과", "계약", "청약경쟁률", "경쟁률", "청약접수",
                      "접수결과", "접수 결과", "접수마감", "시스템", "서비스 일시중단")

# --- attachment kinds and words
ATTACH_APPLICANT = ("당첨자", "예비자", "서류심사대상자", "접수자", "명단", "결과")
ATTACH_FORM = ("신청서", "신청양식", "서식", "개인정보", "동의서")
ATTACH_SHEET_EXT = ("xlsx", "xlsm")
ATTACH_SHEET = ("주택목록", "공급대상", "동호", "호실")
ATTACH_PDF_EXT = ("pdf",)
ATTACH_PDF_SCHEDULE = ("일정", "스케줄")
ATTACH_PDF_NOTICE = ("공고", "모집", "공급", "팸플릿", "주택")
ATTACH_HWP_EXT = ("hwp", "hwpx")
ATTACH_HWP_NOTICE = ("공고", "모집")
KIND_APPLICANT = "applicant_or_winner_file"
KIND_FORM = "application_form"
KIND_SHEET = "offering_list_xlsx"
KIND_SCHEDULE_PDF = "schedule_pdf"
KIND_NOTICE_PDF = "notice_pdf"
KIND_NOTICE_HWP = "notice_hwp"
KIND_UNSUPPORTED = "unsupported"

# --- artifact types, states, versions
ART_PDF_TEXT = "pdf_text"
ART_TABLE_ROW = "pdf_table_row"
ART_HWP_TEXT = "hwp_text"
ART_HWP_UNSUPPORTED = "hwp_unsupported"
ART_API_ITEM = "myhome_api_item"
ART_PREVIEW = "html_preview"
ART_HWPX_TEXT = "hwpx_text"
STATUS_EXTRACTED = "extracted"
STATUS_UNSUPPORTED = "unsupported"
SCHEMA_VERSION = "v1"
SCHEDULE_TEXT_TYPES = (ART_PDF_TEXT, ART_PREVIEW, ART_HWPX_TEXT)
REPAIR_TEXT_TYPES = (ART_PDF_TEXT, ART_PREVIEW, ART_HWP_TEXT, ART_HWPX_TEXT)
REPAIR_ATTACHMENT_KINDS = (KIND_NOTICE_PDF, KIND_NOTICE_HWP)
UNSUPPORTED_REASON = "hwp text extractor is not available"

# --- evidence spans
OBJECT_SCHEME = "object://"
API_SOURCE = "myhome"
API_SCHEME = "myhome://"

# --- confidence per producer
CONF_TEXT = 1.0
CONF_TABLE_ROW = 0.78
CONF_SHEET_ROW = 0.72
CONF_TEXT_UNIT = 0.64
CONF_API_OFFERING = 0.95
CONF_API_SCHEDULE = 1.0
CONF_TEXT_SCHEDULE = 0.86
CONF_PROCEDURE_SCHEDULE = 0.82

# --- quality gate
QA_APPROVED = "approved"
QA_REJECTED = "rejected"
QA_PENDING = "pending"
LABEL_MAX_CHARS = 256
NAME_MAX_CHARS = 128
CORRUPT_CHAR = "�"
REFERENCE_ONLY_PHRASE = "자세한 사항"
REFERENCE_ONLY_PHRASES = ("자세한 사항", "상세내역")

# --- application status
APP_OPEN = "청약중"
APP_PENDING = "접수예정"

# --- seen cache
SEEN_REJECTED = "rejected"
SEEN_UNKNOWN = "rejected_unknown"
SEEN_TTL_DAYS = {SEEN_REJECTED: 60, SEEN_UNKNOWN: 7}

# --- limits
REPAIR_CAP = 1500
REPAIR_CHARS = 12000
REPAIR_LIST_DEFAULT = 20
SERVE_DEFAULT = 200
SERVE_MAX = 1000
FILENAME_MAX_CHARS = 180
TRUNCATION_MARK = "\n[TRUNCATED]"
REDACTION_MARK = "[REDACTED]"

# --- registry of boards and application lists
BOARDS = (("SH", "rental", "SH 주택임대", "https://www.i-sh.co.kr",
           "/app/lay2/program/S48T1581C563/www/brd/m_247/list.do",
           "/app/lay2/program/S48T1581C563/www/brd/m_247/view.do"),)
APPLICATION_BASE = "https://www.i-sh.co.kr"
APPLICATION_LISTS = (
    ("01", "장기전세", "/app/lay2/program/S48T560C607/m_26/appNoti/appUser_list.do"),
    ("02", "국민임대", "/app/lay2/program/S48T1588C614/m_27/appNoti/appUser_list.do"),
    ("03", "공공임대", "/app/lay2/program/S48T1587C612/m_14/appNoti/appUser_list.do"),
    ("04", "매입임대", "/app/lay2/program/S48T1589C616/m_32/appNoti/appUser_list.do"),
    ("05", "재개발임대", "/app/lay2/program/S48T1592C621/m_36/appNoti/appUser_list.do"),
    ("06", "희망하우징", "/app/lay2/program/S48T1591C619/m_40/appNoti/appUser_list.do"),
    ("07", "행복주택", "/app/lay2/program/S48T1594C624/m_66/appNoti/appUser_list.do"),
    ("12", "전세임대", "/app/lay2/program/S48T572C4932/m_78/appNoti/appUser_list.do"),
    ("10", "장기안심", "/app/lay2/program/S48T2731C2712/m_79/appNoti/appUser_list.do"),
)

# --- API item fields (column, JSON field, reading)
API_FIELDS = (
    ("notice_id", "pblancId", "text"), ("house_sn", "houseSn", "int0"), ("status", "sttusNm", "text"),
    ("title", "pblancNm", "text"), ("agency", "suplyInsttNm", "text"), ("house_type", "houseTyNm", "text"),
    ("supply_type", "suplyTyNm", "text"), ("posted_date", "rcritPblancDe", "text"),
    ("winner_date", "przwnerPresnatnDe", "text"), ("supply_count_text", "suplyHoCo", "text"),
    ("reference", "refrnc", "text"), ("source_url", "url", "text"), ("detail_url", "pcUrl", "text"),
    ("mobile_url", "mobileUrl", "text"), ("complex_name", "hsmpNm", "text"), ("province", "brtcNm", "text"),
    ("city", "signguNm", "text"), ("address", "fullAdres", "text"), ("legal_dong", "refrnLegaldongNm", "text"),
    ("pnu", "pnu", "text"), ("heating_method", "heatMthdNm", "text"), ("total_household", "totHshldCo", "text"),
    ("deposit_krw", "rentGtn", "money"), ("monthly_rent_krw", "mtRntchrg", "money"),
    ("contract_payment_krw", "enty", "money"), ("interim_payment_krw", "prtpay", "money"),
    ("balance_payment_krw", "surlus", "money"), ("application_begin", "beginDe", "text"),
    ("application_end", "endDe", "text"),
)
API_SUM_COUNT_FIELD = "sumSuplyCo"
API_OK_CODE = "00"
DETAIL_LABELS = (("supply_count_text", "공급호수"), ("target_house_info_text", "대상 주택 정보"),
                 ("support_limit_text", "지원한도액"), ("rent_condition_text", "임대조건"),
                 ("lease_period_text", "임대기간"), ("notice_file_text", "공고문"))
ENRICH_SUPPLY_TYPES = ("전세임대", "매입임대")
LABEL_DEPOSIT = "임대보증금"
LABEL_RENT = ("월임대료", "임대료")
COMBINED_RENT_WORDS = ("임대보증금", "임대료")
COMBINED_RENT_PHRASES = ("시중 전세가", "시중 전세가격")

# --- patterns
WS = "[\\t\\n\\x0B\\f\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
NUMBER = r"[-+]?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"
MONEY = r"[0-9]+(?:,[0-9]{3})+"
UNIT_COUNT = r"([0-9][0-9,]*)\s*호"
SEQ_LINK = r"getDetailView\(['\"]?([0-9]+)['\"]?\)"
PAGE_JSON_ARRAY = r"(?s)initParam\.downList\s*=\s*(\[[^\n;]*\])"
PREVIEW_LINK = r"brd_id=([^&]+).*seq=([^&]+).*file_seq=([^&]+)"
APPLICATION_CALL = r"userSsnCheck\((.*)\)"
NOTICE_FILE_CALL = r"fnDownFile\('([^']+)'\s*,\s*'([^']+)'\)"
UNSAFE_KEY_CHARS = r"[^0-9A-Za-z가-힣._() \-\[\]]+"
BRANCH_ROAD = r"(대로|로) ([0-9]+길)"
BRANCH_ROAD_LOOSE = r"(대로|로)\s+([0-9]+)\s+길"
KOREAN_MONEY = "([0-9]+)\\s*(?:억|�)\\s*(?:([0-9,]+)\\s*만\\s*원?|원)"
EOK = 100_000_000
MAN = 10_000
EOK_MAX = 30
ADDRESS_GLUED = ("길", "로", "가", "동")
ADDRESS_SPACED_AFTER = ("시", "도", "구", "군", "동", "길", "로")
DISTRICT_ENDINGS = ("구", "군")
TOKEN_TRIM = "[](){}:："
CELL_TOKEN_TRIM = " \t\r\n,.;:()[]{}"
THOUSAND_WON = ("천원", "천 원")
RENT_LINE = r"^[0-9]{1,3}(?:,[0-9]{3})+$"
RENT_START = "임대조건"
RENT_HEADER_NEEDS = ("보증금", "임대료")
RENT_BREAKDOWN_NEEDS = ("계약금", "잔금")
RENT_HEADER_LINES = 40
RENT_TABLE_LINES = 180
RENT_STOP_LINE = "■"

SCHEDULE_RANGE = r"(?s)(청약신청\s*접수기간|신청\s*기간|신청\s*접수|신청접수|접수기간)\s*[:：]?\s*([0-9]{4})\s*[.\-/년]\s*([0-9]{1,2})\s*[.\-/월]\s*([0-9]{1,2})\s*[.\-/일]?\s*(?:\([^)]*\))?\s*(?:(\d{1,2})\s*:\s*(\d{2}))?\s*(?:부터)?\s*[~∼\-�]\s*([0-9]{4})\s*[.\-/년]\s*([0-9]{1,2})\s*[.\-/월]\s*([0-9]{1,2})\s*[.\-/일]?\s*(?:\([^)]*\))?\s*(?:(\d{1,2})\s*:\s*(\d{2}))?"
PROCEDURE_DATE = r"[‘'`]?([0-9]{2,4})\s*[.]\s*([0-9]{1,2})\s*[.]\s*([0-9]{1,2})\s*[.]?\s*(?:\([^)]*\))?\s*(?:(\d{1,2})\s*:\s*(\d{2}))?\s*(?:[~∼\-�]\s*[‘'`]?(?:([0-9]{2,4})\s*[.]\s*)?([0-9]{1,2})\s*[.]\s*([0-9]{1,2})\s*[.]?\s*(?:\([^)]*\))?\s*(?:(\d{1,2})\s*:\s*(\d{2}))?)?"
FIRST_DATE = r"[‘'`]?[0-9]{2,4}\s*[.]\s*[0-9]{1,2}\s*[.]\s*[0-9]{1,2}"
PROCEDURE_STARTS = ("공급절차 및 일정", "■ 공급일정")
PROCEDURE_STOP = "※"
PROCEDURE_SEPARATORS = "[▶➤]"
APPLY_LABEL = "신청접수"

# --- sheet headers: (role, exact keys, contained words), first rule wins per cell
HEADER_ROLES = (
    ("application_unit_label", ("신청단위", "신청가능단위"), ()),
    ("supply_method", ("공급방법", "공급방식"), ()),
    ("application_category", ("유형", "신청유형", "공급유형"), ()),
    ("supply_category", ("공급구분",), ()),
    ("list_no", ("번호", "연번", "목록번호"), ()),
    ("district", ("자치구", "구"), ()),
    ("address", ("주소",), ("소재지",)),
    ("legal_dong", ("법정동", "동명"), ()),
    ("address_detail", (), ("상세주소",)),
    ("housing_name", ("주택명", "단지명", "건물명"), ()),
    ("building_name", ("동", "주택동", "건물동"), ()),
    ("unit_no", ("호", "호수", "동호", "동호수"), ()),
    ("floor_no", ("층", "해당층"), ()),
    ("unit_type", (), ("타입", "형별", "주택형")),
    ("structure_type", (), ("구조",)),
    ("exclusive_area_m2", (), ("전용면적", "전용")),
    ("area_pyeong", (), ("평",)),
    ("deposit", (), ("보증금",)),
    ("jeonse_deposit", (), ("전세금액", "전세금")),
    ("contract_deposit", (), ("계약금",)),
    ("balance_payment", (), ("잔금",)),
    ("monthly_rent", ("임대료",), ("월임대료", "월세")),
    ("supply_count", (), ("공급호수", "세대수", "호수계")),
    ("reserved_count", ("예비",), ("예비호수",)),
    ("gender_requirement", ("성별",), ()),
    ("occupancy_type", (), ("주택유형", "실유형", "거주유형")),
    ("capacity_persons", (), ("인실", "수용인원")),
    ("dormitory_fee", (), ("기숙사비",)),
    ("heating_method", (), ("난방",)),
    ("move_in_start_text", (), ("입주시작", "입주예정")),
    ("direction", (), ("방향", "향")),
    ("status", (), ("상태", "공가")),
)
HEADER_COUNTING = ("unit_no", "supply_count")
HEADER_DESCRIBING = ("exclusive_area_m2", "unit_type", "deposit", "monthly_rent")
APPLICANT_WORDS = ("접수번호", "성명", "생월일")
MERGED_RENT_WORD = "임대료"

# --- tables found in document text
UNIT_SECTION = ("호실별 규모 및 임대조건", "기타사항")
UNIT_ROW = (r"(?:(서울시|[가-힣]+구)\s+)?([0-9]+)\s+([0-9]{3,4})\s+([0-9]+(?:\.[0-9]+)?)\s+([0-9]+(?:\.[0-9]+)?)"
            r"\s+([0-9,]+)\s+([0-9,]+)\s+([0-9,]+)\s+([0-9,]+)")
UNIT_ADDRESS = r"서울특별시\s+([가-힣]+구)\s+([가-힣0-9]+동)\s+([0-9]+(?:-[0-9]+)?)\s+[0-9]+\s+호"
VACANCY_SECTION = ("공실 정보", "임대 기간")
VACANCY_ROW = (r"([가-힣A-Za-z0-9_]+)\s+([0-9]{3,4})\s*호\s+([0-9]+(?:\.[0-9]+)?)\s*㎡\s+[0-9]+(?:\.[0-9]+)?\s*㎡"
               r"\s+[0-9]+(?:\.[0-9]+)?\s*룸\s+([0-9,]+)\s+([0-9,]+)")
VACANCY_ADDRESS = r"서울시\s+[가-힣]+구\s+[가-힣0-9]+\s+[0-9]+\s+길\s+[0-9]+"
SHARED_NAME = "휘경마을 두레주택"
SHARED_ADDRESS = "서울시 동대문구 망우로18다길 31-5"
SHARED_GATES = ("휘경마을 두레주택", "임대보증금 및 월임대료")
SHARED_SECTION = ("임대보증금 및 월임대료", "임대기간")
SHARED_UNIT = r"(?<![0-9A-Za-z_])(20[0-9])\s+([0-9]+(?:\.[0-9]+)?)(?![0-9A-Za-z_])"
GROUP_NAME = "충신동 연극인 두레주택"
GROUP_GATES = ("충신동 연극인 두레주택", "호점 내 호실은 선택 불가", "임대보증금 및 월임대료")
GROUP_HEAD = r"([0-9]+)\s*호점\s+종로구\s+충신동\s+([0-9]+-[0-9]+)"
GROUP_ADDRESS_PREFIX = "서울특별시 종로구 충신동 "
GROUP_ENDS = (" ○ ", " 동일호점 ", " 남성은 ")
GROUP_RENT_SECTION = ("임대보증금 및 월임대료", "○ 임대보증금")
GROUP_SUPPLY_SECTION = ("금회 공급대상", "나 . 임대보증금")
GROUP_SUPPLY_SECTION_ALT = ("공급대상 ( 호점 )", "임대보증금 및 월임대료")
GROUP_COUNT = r"^\s*([0-9]+)\s*호\s+"
GROUP_RENT_ROW = r"([0-9]{3,4})\s+([0-9]+(?:\.[0-9]+)?)\s+([0-9,]+)\s+([0-9,]+)"
GROUP_AUTO_GENDER = (("4", "남성", ("남성은 자동으로 4호점", "남성은 자동으로 4 호점")),
                     ("5", "여성", ("여성은 자동으로 5호점", "여성은 자동으로 5 호점")))
GROUP_SUPPLY_METHOD = "잔여세대"
GROUP_OCCUPANCY = "셰어하우스"
GENDERS = ("남성", "여성")
TYPE_NAME = "마곡 도전숙"
TYPE_GATES = ("마곡 도전숙", "공급현황", "공급유형별 면적 및 임대료")
TYPE_SECTION_START = "공급유형 주택유형"
TYPE_SECTION_END = "세대 내 옵션"
TYPE_SUPPLY_METHOD = "일자리연계형 지원주택"
TYPE_SUFFIX = "㎡형"
TYPE_HEAD = r"[0-9]+㎡형"
TYPE_UNIT = r"[A-Z][0-9]?형"
TYPE_CATEGORY = "주거약자"
HOPE_GATES = ("희망하우징", "공급대상")
HOPE_NAMES = ("내발산 공공기숙사", "정릉 희망하우징", "연남 공공원룸텔")
HOPE_NAME = r"(내발산\s*공공기숙사|정릉\s*희망하우징|연남\s*공공원룸텔)"
HOPE_ROW = HOPE_NAME + r"\s*(원룸형\s*1\s*인실(?:\s*\([^)]+\))?)\s*([0-9]+(?:\.[0-9]+)?)\s*㎡?\s*((?:(?:남성|여성)\s*[0-9]+\s*)+)"
HOPE_GENDER = r"(남성|여성)\s*([0-9]+)"
HOPE_ADDRESS = (HOPE_NAME + r"\s*·?\s*주소\s*:\s*(서울특별시\s+[가-힣]+구\s+.*?)"
                r"(?=\s+·|\s+주택명|\s+정릉\s*희망하우징|\s+연남\s*공공원룸텔|$)")
HOPE_RENT = HOPE_NAME + r"\s*(-|[0-9,]+\s*원)\s+(-|[0-9,]+\s*원)\s+(-|[0-9,]+\s*원)"
SUPPORT_NAME = "전세임대형 든든주택"
SUPPORT_GATES = ("전세임대형 든든주택", "공급호수")
SUPPORT_COUNT = r"공급호수\s*[:：]\s*([0-9,]+)\s*호"
SUPPORT_SECTION = ("지원금액", "월 임대료")
SUPPORT_AREA = "서울특별시 전 지역"
SUPPORT_AREA_DEFAULT = "서울특별시"
SUPPORT_METHOD = "전세임대"
JEONSE_GATES = ("전세금액", "모집", "호수")
JEONSE_MONEY_UNIT = "천원"
JEONSE_AREAS = ("29", "33", "35", "36", "38", "39", "41", "43", "44", "45", "47", "48", "49", "50", "51", "54", "56",
                "57", "59", "65", "66", "70", "71", "73", "74", "79", "84", "101", "114")
JEONSE_CATEGORIES = ("일반", "주거약자", "우선", "우선공급")
JEONSE_DISTRICTS = ("강남구", "강동구", "강북구", "강서구", "관악구", "광진구", "구로구", "금천구", "노원구", "도봉구",
                    "동대문구", "동작구", "마포구", "서대문구", "서초구", "성동구", "성북구", "송파구", "양천구",
                    "영등포구", "용산구", "은평구", "종로구", "중구", "중랑구", "의정부시")
JEONSE_HEADER_WORDS = ("자치구", "단지명", "전용", "면적", "유형", "모집", "호수", "예비", "전세금액", "세대", "당",
                       "계약면적", "난방", "방식", "계", "계약금", "잔금", "주거", "공용", "기타", "합계")
HEATING_KINDS = ("개별", "지역")
HEATING_WORD = "난방"

# --- single-unit texts
UNIT_TEXT_MARKS = ("공급주택", "공급대상", "임대료", "입주가능일")
FORM_TEXT_MARKS = ("주소", "공급호실", "임대료", "입주가능일")
UNIT_SUFFIX = "호"
UNIT_TEXT_VALUES = 8

# --- labels on landed pages
LIST_TABLE_ID = "listTb"
LABEL_TITLE = "제목"
LABEL_VIEWS = "조회수"
LABEL_POSTED = "작성일"
LABEL_POSTED_INLINE = "등록일"
DETAIL_TABLE_CLASS = "detailTable"
BODY_CLASS = "cont"
PREVIEW_PATH = "htmlConverter.do"
ATTACHMENT_SCHEMA = ("array<struct<brdId:string,seq:string,fileSeq:string,filename:string,oriFileNm:string,"
                     "size:string,fileSize:string,fileTp:string>>")
