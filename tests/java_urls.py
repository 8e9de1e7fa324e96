"""Brute-force feature rows worked out with ``java.net.URL`` itself, one string at a time."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError

from threatsieve.functions import constants as C

CORPUS = [
    "http://a.com/x.apk", "a.com/x.apk", "https://a.com:8443/p/1.2.3.4/x12a34.apk",
    "http://a.com.", "http://.", "http://a.com:/x", "http://a.com:abc/x", "http://a.com:-1/x",
    "http://a.com:-2/x", "http://a.com:+90/x", "http://a.com:99999/x", "http:///x.apk", "http://",
    "foo://a.com/x", "ftp://a.com/x", "HTTP://A.COM/x.exe", "http://u:p@a.com:81/x",
    "http://u@v@a.com/x", "http://a_b.com/x y|z", "a.com/r?u=http://b.com/x.apk",
    "http://a.com?x=1/2", "http://a.com#f/2.apk", "http://[::1]:80/x",
    "http://中文.com/下载12.apk", "http://a.com/😀.apk", "http://a.com/", "http://a.com///",
    " http://a.com/x.apk", "http:foo", "http://.a.com/x", "http://a..com/x", "file://a/x.apk",
    "jar://a/x.apk", "", "http://a.com/-12-3.4.apk", "mailto://a/x", "http://a.com:80:90/x",
    "http://a.com:99999999999/x", "url:http://a.com/x", "http://sexmovie.tk/free~js-@x.sisx",
    "//a.com/x", "://a.com/x", "http//a.com://x",
]
REJECTED = {
    "http://.", "http://a.com:abc/x", "http://a.com:-2/x", "foo://a.com/x",
    "a.com/r?u=http://b.com/x.apk", "http:foo", "jar://a/x.apk", "http://a.com:80:90/x",
    "http://a.com:99999999999/x", "://a.com/x", "http//a.com://x",
}
MORE = [
    "http:////a.com/x", "http:/a.com://x", "http:x://y", "http://u:p@v@x/y", "http://u:p@[::1]:8/x",
    "http://[::1]/x", "http://[::1", "http://[::1]x/y", "http://[::1]:/y", "http://[::1]:8x/y",
    "http://[:1]/", "http://[1::2::3]/", "http://[1:2:3:4:5:6:7:8]/", "http://[1:2:3:4:5:6:7:8:9]/",
    "http://[1:2:3:4:5:6:7::]/", "http://[1:2:3:4:5:6:7:8::]/", "http://[::ffff:1.2.3.4]/",
    "http://[1:2:3:4:5:6:1.2.3.4]/", "http://[::1.2.3.256]/", "http://[::1%eth0]:9/", "http://[%]/",
    "http://[::1%]/", "http://[g::1]/", "http://[12345::1]/", "http://[00001::1]/", "http://[]/x",
    "http://[[::1]/x", "http://a[b]c/x", "http://a.com:80 ", "http://a.com:80 /x", "http://a.com ",
    "http://a.com\n/x", "http://a.com/x\n", "\thttp://a.com\t", "URL:ftp://b:2147483647/",
    "http://b:2147483648/", "http://b:-0/", "http://b:-1", "http://b:00080?x", "http://b:8@c/x",
    "http://b:8@c:9#x:y@z", "http://@c/x", "http://u@/x", "http://:80/x", "http://:80", "https://",
    "jar:http://a.com/x.jar!/p.apk", "jar:http://a.com:x/x.jar!/p", "JAR:file://a/b!/c!/d#e!/f",
    "jar:foo://x!/y", "jar:http://a.com/x.jar!p", " jar:http://a.com/x.jar!/p", "mailto:#://",
    "mailto: ://", "mailto:a@b://c", "http://a.com/x?y@z:9", "http://..a", "http://a...", "http://...",
    "http://a.com:80\u00a0/", "http://\u3000a/", "http://a.com\\x/y", "http://a.com/12\n34.apk",
    "http://a.com/1😀2.apk", "http://a.com/一龿.apk", "http://a.com/𠀀9.zip", "a:b@c:80/x", "1.2.3.4",
    "http://b:0002147483647/", "http://b:2147483639/x", "http://b:1999999999", "http://b:9999999999",
    "http://b:-2", "http://b:-01", "http://b:-10", "http://b:+", "http://b:+-1", "http://. ", "http://. /x",
    "http://.:80/", "http://..:/", "ftp://./x", "jar:http://./x!/y", "jar:http://a:80!/b", "jar:http://a:80!/b!/c",
    "jar:http://a:8x!/b", "jar:url: http://a/x!/b", "jar: url:http://a/x !/b", "jar:mailto:!/://", "jar:mailto:a!/://",
    "jar:http://u@v@x/!/y", "jar:http://[::1]!/y", "http://[::1%25 a]/", "http://[::1%a:b]:1/",
    "http://[2001:db8::1]/x", "http://[fe80::1234:5678:9abc:def0]:8080/x.apk", "http://[::ffff:10.0.0.1]:1/",
    "http://[2001:0db8:0000:0000:0000:ff00:0042:8329]/x", "http://[abcd:abcd:abcd:abcd:abcd:abcd:abcd::]/",
    "http://[abcd:abcd:abcd:abcd:abcd::255.255.255.255]/", "http://[abcd:abcd:abcd:abcd:abcd:abcd::1.2.3.4]/",
    "ftp://a\tb.com/x", "http://a\tb@c.com/x", "https://[::1%a\nb]/x", "ftp://[::1%a\nb]/x", "file://a\x7f/",
]


def java_url(spark, text):
    try:
        return spark._jvm.java.net.URL(text)
    except Py4JJavaError:
        return None


def units(text):
    return len(text.encode("utf-16-be")) // 2


def drop_trailing_empties(parts):
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def feature_row(spark, raw, tlds):
    """The feature values as a tuple in column order, or None for a dropped row."""
    url = raw if "://" in raw else "http://" + raw
    parsed = java_url(spark, url)
    if parsed is None:
        return None
    host = parsed.getHost()
    labels = [""] if host == "" else drop_trailing_empties(host.split("."))
    if not labels:
        return None
    port = parsed.getPort()
    file = drop_trailing_empties(url.split("/"))[-1]
    digits = re.compile(r"-?([0-9]+)[^\n\r\u0085\u2028\u2029]([0-9]+)|-?([0-9]+)")
    return (
        url,
        80 if port == -1 else port,
        len(labels),
        re.search(C.IPV4_PATTERN, url, re.ASCII) is not None,
        units(url),
        sum(term in url for term in C.SENSITIVE_TERMS),
        labels[-1] in tlds,
        url.endswith(C.SENSITIVE_SUFFIXES),
        any("\u4e00" <= c <= "\u9fbf" for c in file),
        units(file),
        sum(units(m.group()) for m in digits.finditer(file)),
    )
