"""URL normalization against the URL class of the JVM."""

from __future__ import annotations

import random

from py4j.protocol import Py4JJavaError

from lamina.functions.urls import normalize_url

# the rules for these are those of the JDK; the JVM may know further schemes
KNOWN = {"http", "https", "ftp", "file", "mailto", "jar"}
PIECES = [
    "http", "HTTPS", "ftp", "file", "mailto", "jar", "url", "custom", ":", ":", "://", "://", "/", "/", "//", "////", "..", ".", "/../", "/./", "/..", "/.",
    "..a", "a", "b.c", "foo_bar.com", "@", "u:p@", "?", "?q=1", "#", "#f", "!/", "!", ":80", ":+80", ":-1", ":-2", ":abc", ":2147483647", ":2147483648",
    ":00000000080", "[::1]", "[1:2:3:4:5:6:7:8]", "[::ffff:1.2.3.4]", "[zz]", "[", "]", " ", "\t", "\n", "\x01", "\x00", "é", "日", ";x", "%2e", "\\", "|",
]
CASES = [
    "http://foo.com/a/./b", "http://foo.com/a/../b", "http://foo.com/../b", "http://foo.com/../../b", "http://foo.com/../../../b", "http://foo.com/a/b/..",
    "http://foo.com/..", "http://foo.com/../..", "http://foo.com/a/..b/c/..", "http://foo.com/..b/c/..", "http://foo.com/a/.", "http://foo.com/.", "http://foo.com/a//../b",
    "http:foo/bar", "http:./foo", "http:.", "http:..", "http:a/../../b", "http:", "http:?x", "http:/a", "http:///a", "http:////a/b", "file:a", "file:/a/../b", "file:///a", "file://h/a?q#f",
    "mailto:a@b.c", "mailto:", "mailto: ", "mailto:a?b?c#d", "jar:http://a/b.jar!/x/../y", "jar:http://a/b.jar", "jar:custom://a!/x", "jar:file:/a.jar!/", " jar:file:/a.jar!/b",
    "jar:file:/a.jar!/x?y?z#w", "jar:mailto:a!/b", "url:http://foo.com/x", "URL:URL:http://foo.com/x", "url:", "http://a@b@c/x", "http://@c/x", "http://c@/x", "http://c:80@d:81/x",
    "http://h:-1/x", "http://h:-2/x", "http://h:+5/x", "http://h:2147483648/x", "http://h:2147483647/x", "http://[::1]/x", "http://[::1]x/x", "http://[::1]:/x", "http://[::1]:8/x", "http://[]/x",
    "http://[1::2::3]/x", "http://[fe80::1%eth0]/x", "http://[1:2:3:4:5:6:7::]/x", "http://[1:2:3:4:5:6:1.2.3.4]/x", "http://[::1.2.3.256]/x", "http://a[b]/x", "\x00http://foo.com/x\x1f", "http://h\x01i/x",
    "#f", "", " ", ":", "//foo/bar", "h ttp://x", "1http://x", "http//x", "http://foo.com#a?b/c", "http://foo.com?a#b/c",
]


def by_jvm(spark, text):
    try:
        url = spark._jvm.java.net.URL(text)
        if url.getProtocol() in KNOWN:
            return f"{url.getProtocol()}://{url.getHost()}{url.getPath()}"
    except Py4JJavaError as e:
        if "MalformedURLException" not in str(e.java_exception):
            raise
    return text


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, u string")
    got = dict(df.select("i", normalize_url("u")).collect())
    wrong = [(t, got[i], want) for i, t in enumerate(texts) if got[i] != (want := by_jvm(spark, t))]
    assert not wrong, (len(wrong), wrong[:10])


def test_cases_as_the_jvm_has_them(spark):
    check(spark, CASES)


def test_random_texts_as_the_jvm_has_them(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    texts += ["http://foo.com" + "".join(rng.choice(["/", "/..", "/.", "/a", "//", "..", "."]) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    texts += [rng.choice(["http", "file", "ftp"]) + ":" + "".join(rng.choice(PIECES[8:]) for _ in range(rng.randint(1, 6))) for _ in range(1500)]
    check(spark, texts)
