"""The page list and the interface rules, as data."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# ---- Fixed values: pages counted by the page filter ----
PAGES = [
    "/MobileInternet/index/uploadData",
    "/MobileInternet/index/version",
    "/MobileInternet/Creategroup/check",
    "/MobileInternet/Creategroup/create",
    "/MobileInternet/Creategroup/join",
    "/MobileInternet/Creategroup/signout",
    "/MobileInternet/index/getBanner",
    "/MobileInternet/index/mileageUpload",
    "/MobileInternet/index/msxiaoice",
    "/MobileInternet/index/sn",
    "/MobileInternet/index/uploadLocus",
    "/MobileInternet/index/uploadUseLog",
    "/MobileInternet/Music/collectionList",
    "/MobileInternet/Music/doMusicCollect",
    "/MobileInternet/Music/menuMusicList",
    "/MobileInternet/Music/menuRecList",
    "/MobileInternet/Radio/collect_radio",
    "/MobileInternet/Radio/collectRadio_list",
    "/MobileInternet/Radio/is_collect",
    "/MobileInternet/Service/canLink",
    "/MobileInternet/service/checkCode",
    "/MobileInternet/service/getCode",
    "/MobileInternet/service/getIcon",
    "/MobileInternet/user/delCollectRecord",
    "/MobileInternet/user/getPreset",
    "/MobileInternet/user/getSearchList",
    "/MobileInternet/user/getUsers",
    "/MobileInternet/user/putCollectRecord",
    "/MobileInternet/user/putSearchRecord",
    "/MobileInternet/user/welcome",
    "/MobileInternet/Voice/order_json",
]

# ---- Fixed values: texts shared by the rules ----
NO_DETAIL = "无详细内容"
NO_LOCATION = "无法获取位置信息"
LOCATION_PREFIX = "上报位置："
COLLECTED_SONGS = "收藏歌曲"
COLLECTED_LISTS = "收藏歌单"

# ---- Fixed values: one row per path spelling ----
# path, act, action, detail kind, detail prefix, detail parameter, detail suffix, location parameter
# detail kinds: text = the prefix alone; bare = the parameter alone; wrap = prefix+parameter+suffix;
# choice = by the parameter being '0'. A location parameter of '' means the no-location text.
RULES = [
    ("/MobileInternet/index/mileageUpload", "mileageUpload", "里程数上报", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/mileageUpload\\", "mileageUpload", "里程数上报", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/uploadLocus", "uploadLocus", "上报轨迹", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/uploadLocus\\", "uploadLocus", "上报轨迹", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/uploadData", "uploadData", "连接上报", "wrap", "使用app：", "appname", "", "city"),
    ("/MobileInternet/index/version", "version", "固件升级", "wrap", "版本更新：", "version", "", "location"),
    ("/MobileInternet/Creategroup/check", "check", "位置共享", "text", "检查是否在群组", None, None, "city"),
    ("/MobileInternet/Creategroup/create", "create", "位置共享", "text", "建群", None, None, "city"),
    ("/MobileInternet/Creategroup/join", "join", "位置共享", "text", "加入群组", None, None, "location"),
    ("/MobileInternet/Creategroup/join/", "join", "位置共享", "text", "加入群组", None, None, "location"),
    ("/MobileInternet/Creategroup/signout", "signout", "位置共享", "text", "退出群组", None, None, "location"),
    ("/MobileInternet/Creategroup/signout/", "signout", "位置共享", "text", "退出群组", None, None, "location"),
    ("/MobileInternet/index/getBanner", "getBanner", "广告位图片列表", "text", NO_DETAIL, None, None, ""),
    ("//MobileInternet/index/getBanner", "getBanner", "广告位图片列表", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/getBanner/", "getBanner", "广告位图片列表", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/index/msxiaoice", "msxiaoice", "微软小冰", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/index/sn", "sn", "设备序列号信息上报", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/Music/collectionList", "collectionList", "收藏列表", "choice", None, "type", None, "location"),
    ("/MobileInternet/Music/doMusicCollect", "doMusicCollect", "收藏或取消收藏", "bare", None, "track_name", None, "location"),
    ("/MobileInternet/Music/menuMusicList", "menuMusicList", "车友歌单:音乐列表", "wrap", "歌单id：", "id", "", "location"),
    ("/MobileInternet/Music/menuRecList", "menuRecList", "歌单列表", "wrap", "歌单列表第：", "page", "页", "location"),
    ("/MobileInternet/Radio/collect_radio", "collect_radio", "收藏电台", "bare", None, "title", None, "location"),
    ("/MobileInternet/Radio/collectRadio_list", "collectRadio_list", "查看电台热门分类", "wrap", "查看电台热门分类第", "page", "页", "location"),
    ("/MobileInternet/Radio/is_collect", "is_collect", "查看是否收藏电台", "wrap", "查看看是否收藏电台：", "channel_id", "", "location"),
    ("/MobileInternet/service/checkCode", "checkCode", "根据SN检测激活状态", "text", NO_DETAIL, None, None, "location"),
    ("//MobileInternet/service/checkCode", "checkCode", "根据SN检测激活状态", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/service/checkCode\\", "checkCode", "根据SN检测激活状态", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/service/getCode", "getCode", "根据SN获取二维码", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/user/getPreset", "getPreset", "获取预设地址", "bare", None, "location", None, "location"),
    ("/MobileInternet/user/getSearchList", "getSearchList", "导航搜索列表", "wrap", "导航搜索列表:第", "page", "页", "city"),
    ("/MobileInternet/user/getUsers", "getUsers", "导航-用户地址", "bare", None, "location", None, "location"),
    ("/MobileInternet/user/putSearchRecord", "putSearchRecord", "添加导航搜索记录", "bare", None, "addr", None, "city"),
    ("/MobileInternet/user/welcome", "welcome", "开机", "text", NO_DETAIL, None, None, "location"),
    ("/MobileInternet/Voice/order_json", "order_json", "上传文件", "text", NO_DETAIL, None, None, ""),
    ("/MobileInternet/user/putCollectRecord", "putCollectRecord", "添加导航收藏", None, None, None, None, None),
]
# ---- end of fixed values ----

RULE_COLUMNS = [
    "path", "act", "action", "detail_kind", "detail_prefix", "detail_param", "detail_suffix", "loc_param",
]


def detail_params() -> list[str]:
    return sorted({r[5] for r in RULES if r[5]})


def location_params() -> list[str]:
    return sorted({r[7] for r in RULES if r[7]})


def interface_dim(spark: SparkSession) -> DataFrame:
    """The rules as a table. It is a local relation of fixed size, so broadcasting it is always safe."""
    schema = pa.schema([(c, pa.string()) for c in RULE_COLUMNS])
    rows = [dict(zip(RULE_COLUMNS, r)) for r in RULES]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
