import base64
import random
import time

import pytest

from starflow.llm import secret_scan as X


def der(tag, body):
    size = len(body)
    if size < 128:
        return bytes([tag, size]) + body
    wide = (size.bit_length() + 7) // 8
    return bytes([tag, 0x80 | wide]) + size.to_bytes(wide, "big") + body


def rsa(rng):
    numbers = [b"\0"] + [b"\1" + rng.randbytes(rng.choice([64, 128])) for _ in range(8)]
    return der(0x30, b"".join(der(2, n) for n in numbers))


def wrapped(rng):
    return der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, der(0x30, der(2, b"\1") + der(4, rng.randbytes(32)))))


def ec(rng):
    return der(0x30, der(2, b"\1") + der(4, rng.randbytes(32)) + der(0xA0, der(6, b"\x2a\x86")))


def openssh(rng):
    def string(b):
        return len(b).to_bytes(4, "big") + b

    return (b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big")
            + string(rng.randbytes(51)) + string(rng.randbytes(136)))


@pytest.mark.parametrize("make", [rsa, wrapped, ec, openssh])
def test_keys_anywhere_in_a_run(make):
    """At every alignment, after other starts in the same run, wrapped, in either alphabet, and cut short."""
    rng = random.Random(7)
    for k in range(24):
        key = make(rng)
        code = (base64.urlsafe_b64encode if k % 2 else base64.b64encode)(key).decode().rstrip("=")
        lead = ["", "M", "MIMBAAAC", "b3BlbnNzaC1rZXktdjEA", "xMIIEpAIBAAKCAQEA"][k % 5] + "A" * (k % 4)
        body = "\n".join(code[i:i + 64] for i in range(0, len(code), 64)) if k % 3 else code
        text = f"see {lead}{body} end"
        spans = [(text[s:e].replace("\n", ""), X.KINDS[kind]) for s, kind, e in X.find(text) if X.KINDS[kind] == "key"]
        assert spans == [(code, "key")], (make.__name__, k)
        assert X.der_key_size(key, 0) == (len(key) if make is not openssh else None)
        short = text.replace(code[-8:], "") if "\n" not in body else text.replace(code[-4:], "")
        assert not [s for s in X.find(short) if X.KINDS[s[1]] == "key" and text[s[0]:s[2]] == code]


@pytest.mark.parametrize("piece", ["MIMBAAAC", "b3BlbnNzaC1rZXktdjEA", "MIIEpAIBAAKCAQEA", "M", "MIMBAAAC\\n", "MIMBAAAC\n",
                                   "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJ9.", "\\u002b", "password", "password=", "AKIA", "0a"])
def test_time_in_proportion_to_the_text(piece):
    def seconds(size):
        text = piece * (size // len(piece))
        begin = time.process_time()
        X.find(text)
        return time.process_time() - begin

    small, large = seconds(100_000), seconds(1_000_000)
    assert large < 6 and large < 40 * small + 0.5


def test_random_bytes_are_no_keys():
    rng = random.Random(3)
    for _ in range(300):
        data = bytes([0x30, 0x82]) + rng.randbytes(400)
        assert X.der_key_size(data, 0) is None or X.der_private_key(data[:X.der_key_size(data, 0)])
    assert X.der_key_size(b"", 0) is None and X.openssh_size(b"openssh-key-v1\0") is None
